"""Byte-level BPE, token files and chat formatting: equal to whole-text encoding, and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.data import SCHEMA, documents, frame
from tidemark.llm import byte_bpe, chat, queries, token_files
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.queries import BYTE_PATTERN, BYTE_RANKS, PLANTED, WORD_BPE

ODD = list("ab 1\n\t  　'sé漢😀\x1c.!  İßẛ̣각") + ["<|endoftext|>", "'ll", "  ", "\r\n"]


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_byte_bpe_equals_whole_text_encoding(spark):
    rows = documents() + list(enumerate(odd_texts(300), 100)) + [(None, "x"), (1, "y")]
    own = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=byte_bpe.read_ranks(BYTE_RANKS), special_tokens={})
    got = byte_bpe.decode(byte_bpe.encode(frame(spark, rows, clashing=True), BYTE_RANKS, BYTE_PATTERN), BYTE_RANKS).collect()
    want = [(d, own.encode_ordinary(t or ""), (t or "").encode(), t or "") for d, t in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded), r.text) for r in got), key=repr) == sorted(want, key=repr)


def test_digests_of_ids_and_bytes(spark):
    own = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=byte_bpe.read_ranks(BYTE_RANKS), special_tokens={})
    encoded = byte_bpe.encode(frame(spark), BYTE_RANKS, BYTE_PATTERN)
    rows = byte_bpe.digests(byte_bpe.decode(encoded, BYTE_RANKS)).collect()
    assert sorted(rows) == sorted(byte_bpe.digests(byte_bpe.encode(frame(spark), BYTE_RANKS, BYTE_PATTERN, decoded=True)).collect())
    for r in rows:
        text = dict(documents())[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_offsets_cover_split_characters(spark):
    text = "naïve 漢字 😀 end"
    row = byte_bpe.encode(frame(spark, [(1, text), (2, "")]), BYTE_RANKS, BYTE_PATTERN, offsets=True).orderBy("doc_id").collect()
    table = byte_bpe._byte_table(byte_bpe.tokenizer_json(BYTE_RANKS))
    assert row[1].ids == row[1].starts == []
    for i, a, b in zip(row[0].ids, row[0].starts, row[0].ends):
        assert table[i] in text[a:b].encode()
    assert row[0].starts[0] == 0 and row[0].ends[-1] == len(text)


def test_an_incomplete_character_is_marked(spark):
    ids = [r for r in byte_bpe.encode(frame(spark, [(1, "😀")]), BYTE_RANKS, BYTE_PATTERN).first().ids]
    df = spark.createDataFrame([(1, ids[:1]), (2, None), (3, ids)], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r for r in byte_bpe.decode(df, BYTE_RANKS).collect()}
    assert "\ufffd" in got[1].text and got[1].decoded == "😀".encode()[:len(got[1].decoded)] and got[2].text == "" and got[3].text == "😀"


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_tells_strangers(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    own, _ = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(own.slots(keys).tolist()) == list(range(len(keys)))
    assert (own.slots(keys ^ np.uint64(1))[~np.isin(keys ^ np.uint64(1), keys)] >= 0).sum() <= 1


def test_perfect_hash_refuses_equal_keys():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([7, 7], np.uint64))


def test_token_files_give_back_every_document(spark, tmp_path):
    rows = documents() + list(enumerate(odd_texts(200), 100)) + [(None, "null key"), (3, "again"), (3, "again")] + [(-9, "many")] * 500
    folder, tokenizer = f"file://{tmp_path}/files", Tokenizer.from_file(WORD_BPE)
    token_files.write_token_files(frame(spark, rows, clashing=True), folder, WORD_BPE, 1)
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    scanned = token_files.scan_token_files(spark, folder).orderBy("start").collect()
    assert [r.start for r in scanned] == np.concatenate([[0], np.cumsum([r.n_tokens for r in scanned])[:-1]]).tolist()
    assert [r.doc_id for r in scanned] == sorted([d for d, _ in rows], key=lambda d: (d is not None, d))
    want = sorted(((d, np.array(ids(t), "<u4").tobytes()) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in scanned), key=repr) == want
    keys = frame(spark, rows + [(10**12, "not there")])
    found = token_files.read_token_files(keys, folder).collect()
    place = lambda r: (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids))
    assert sorted(map(place, found)) == sorted(place(r) for r in scanned if r.doc_id is not None)


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = f"{tmp_path}/none"
    assert token_files.write_token_files(frame(spark, []), folder, WORD_BPE, 1).count() == 0
    assert token_files.read_token_files(frame(spark), folder).count() == token_files.scan_token_files(spark, folder).count() == 0


TURN_TEXT = st.lists(st.sampled_from(["\\", "#", "###", "</turn>", "\n", " ", "a", "### user: ", "\n</turn>\n", "é", "<", "turn>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a b:\n", "###"]), TURN_TEXT), max_size=5))
def test_turns_read_back_as_themselves(turns):
    parsed = chat.parse("".join(chat.format_turn(r, t) for r, t in turns))
    assert [(r, t) for r, t, *_ in parsed] == turns


@pytest.mark.parametrize("text", ["### user: x", "### user: a ### b\n</turn>\n", "### user: a\n</turn>\nrest", "a", "### us er: a\n</turn>\n"])
def test_bad_grammar_is_told(text):
    with pytest.raises(ValueError):
        chat.parse(text)


def test_conversations_digest_their_written_output(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", PLANTED), (1, 1, "assistant", "twice"), (1, None, "system", None), (None, 0, None, "x"),
            (2, 5, "user", ""), (-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)] + [(9, i, "assistant", f"turn {i} \\###") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'z' AS conv", "1 AS n", "'q' AS said")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    assert set(got) == {1, None, 2, -7, 9}
    turns = [("assistant", f"turn {i} \\###") for i in range(3000)]
    assert got[9].n_turns == 3000 and got[9].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[9].loss_sha256 == hashlib.sha256("".join(t for _, t in turns).encode()).hexdigest()
    assert got[-7].loss_chars == len(PLANTED) and got[-7].formatted_chars == sum(len(chat.format_turn(r, PLANTED)) for r in ("user", "assistant"))
    assert got[1].n_turns == 4 and got[1].loss_chars == len(PLANTED) + 5 and got[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0


def test_token_query_returns_rows_with_null_ids(spark, tmp_path):
    rows = [(3, "one two"), (None, "a b"), (None, None), (1, "z"), (3, "one two")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.start, r.n_tokens) for r in queries.op2_token_files(spark, str(tmp_path)).collect()]
    assert sorted((d is not None, d or 0) for d, *_ in got) == [(False, 0), (False, 0), (True, 1), (True, 3), (True, 3)]
    at = 0
    for _, start, n in sorted(got, key=lambda r: r[1]):  # nulls first, nothing between
        assert start == at
        at += n
