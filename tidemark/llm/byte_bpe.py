"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding by the byte table."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.functions.memory import give_back
from tidemark.llm.chunks import MOST_PIECES, Memory, encode_items, no_collection
from tidemark.llm.staging import column, id_and_text, lists, pieces, text_column, tidy

#: A cut that no match can cross: before a space that follows a character other than white space.
_CUT = re.compile(r"(?<=\S)(?= )")
_RUN = re.compile(r"\s ")
#: Text that is encoded at once.
READ_BYTES = 512 << 10


def byte_characters() -> list[str]:
    """The visible character of each byte: itself if it prints, else the next one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge gives the token: merge by rank until two parts are left."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        own = ranks[token]
        at = min(range(len(parts) - 1), key=lambda i: ranks[pair] if (pair := parts[i] + parts[i + 1]) in ranks and ranks[pair] < own else len(ranks) + 256)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=4)
def tokenizer_json(path: str) -> str:
    """A rank file as a tokenizer over byte characters, which splits at spaces only."""
    ranks, shown = read_ranks(path), byte_characters()
    show = lambda token: "".join(shown[b] for b in token)
    merges = [tuple(map(show, _halves(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    return _tokenizer({show(t): r for t, r in ranks.items()}, merges).to_str()


def _tokenizer(vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> Tokenizer:
    """Without a memory of its own, as each distinct match is encoded once."""
    own = Tokenizer(models.BPE(vocabulary, merges, cache_capacity=0, ignore_merges=True))
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return own


class Encoder:
    """Texts to id bytes (int32), with memories of the stretches seen in this worker."""

    def __init__(self, spec: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model, self.find = json.loads(spec)["model"], regex.compile(pattern).findall
        self.tokenizer = _tokenizer(model["vocab"], list(map(tuple, model["merges"])))
        self.shown = dict(enumerate(byte_characters()))
        self.parts = Memory(self._encode_parts, MOST_PIECES)
        self.whole = Memory(self._encode)
        self.spaced = Memory(lambda chunks: self._encode([" " + c for c in chunks]))

    def _encode(self, stretches: list[str]) -> list[bytes]:
        matches = list(map(self.find, stretches))
        self.parts.learn(matches)
        known = self.parts
        return [known[m[0]] if len(m) == 1 else b"".join([known[x] for x in m]) for m in matches]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        shown = [p.encode().decode("latin-1").translate(self.shown) for p in parts]
        return encode_items(self.tokenizer, shown, np.dtype(np.int32), whole_words=True)

    def forget(self) -> None:
        """Free the memories: a worker lives on after its task, beside those of later stages."""
        for memory in (self.parts, self.whole, self.spaced):
            memory.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        with no_collection():
            return self._encode_texts(texts)

    def _encode_texts(self, texts: list[str]) -> list[bytes]:
        split = [_CUT.split(t) if _RUN.search(t) else None for t in texts]
        plain = [t.split(" ") if s is None else [""] for t, s in zip(texts, split)]
        self.whole.learn([s or p[:1] for s, p in zip(split, plain)])
        self.spaced.learn([p[1:] for p in plain])
        whole, spaced = self.whole.__getitem__, self.spaced.__getitem__
        return [b"".join(map(whole, s)) if s else whole(p[0]) + b"".join(map(spaced, p[1:])) for s, p in zip(split, plain)]


@lru_cache(maxsize=2)
def _encoder(spec: str, pattern: str) -> Encoder:
    return Encoder(spec, pattern)


@lru_cache(maxsize=2)
def _byte_table(spec: str) -> list[bytes]:
    """The bytes of each id: the byte characters reversed."""
    value = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = json.loads(spec)["model"]["vocab"]
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(value[c] for c in token)
    return table


def token_spans(ids: list[int], table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 character of each token; a token with part of a character covers the whole of it."""
    ends = np.cumsum([len(table[i]) for i in ids])
    data = np.frombuffer(b"".join([table[i] for i in ids]), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[np.concatenate([[0], ends[:-1]])], character[ends - 1] + 1


def _encode(spec: str, pattern: str, offsets: bool, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec, pattern)
        for batch in batches:
            for part in pieces(batch, most_bytes=READ_BYTES):
                coded = encoder.encode(text_column(part).to_pylist())
                values = np.frombuffer(b"".join(coded), np.int32)
                ends = np.cumsum([len(c) // 4 for c in coded])
                out = {"id": column(part, "id"), "ids": lists(values, ends, pa.int32())}
                if decoded:
                    bytes_of = _byte_table(spec).__getitem__
                    out["decoded"] = pa.array([b"".join(map(bytes_of, own.tolist())) for own in np.split(values, ends[:-1])], pa.binary())
                if offsets:
                    table = _byte_table(spec)
                    each = [token_spans(own.tolist(), table) if len(own) else (own, own)
                            for own in np.split(values, ends[:-1])]
                    for k, name in enumerate(("starts", "ends")):
                        out[name] = lists(np.concatenate([e[k] for e in each]).astype(np.int32), ends, pa.int32())
                del coded
                yield pa.record_batch(out)
                give_back()
        # A worker lives on after its task, beside those of later stages: the tokenizer goes too, and is made again in a moment.
        encoder.forget()
        _encoder.cache_clear()
        _byte_table.cache_clear()

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False,
           decoded: bool = False) -> DataFrame:
    """(id, ids): the tokens of each whole text, without special tokens.

    ``ranks_path`` is a file of base64 tokens and ranks, read on the driver. Its merges are rebuilt for the
    tokenizers library over byte characters. Each match of ``pattern`` is encoded by
    itself; texts are cut only where no match can cross, and each distinct stretch
    is encoded once per batch. With ``offsets``, ``starts`` and ``ends`` give each token's
    characters; tokens that share a character each cover it. With ``decoded`` the ids' bytes come along, as from
    ``decode`` but without a second pass through Python.

    Null is empty and has no ids. Null and repeated ids are returned as they are. Other columns are ignored.
    """
    kinds = "id bigint, ids array<int>" + (", decoded binary" if decoded else "") + (", starts array<int>, ends array<int>" if offsets else "")
    run = _encode(tokenizer_json(ranks_path), pattern, offsets, decoded)
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), kinds).withColumnRenamed("id", id_col)


def _decode(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(spec)
        for batch in batches:
            ids = column(batch, "ids")
            for low in range(0, batch.num_rows, 256):
                some = ids.slice(low, 256)
                data = [b"".join([table[i] for i in own]) for own in some.fill_null([]).to_pylist()]
                yield pa.record_batch({
                    "id": column(batch, "id").slice(low, 256), "ids": some, "decoded": pa.array(data, pa.binary()),
                    "text": pa.array([d.decode(errors="replace") for d in data], pa.string())})

    return run


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded, text): the bytes of all tokens, and their text.

    Bytes are joined before they become characters, so a character split over
    tokens is whole again; one that stays incomplete shows as U+FFFD in ``text``
    and is exact in ``decoded``. Null ids are empty. An id outside the vocabulary raises an error.
    """
    own = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return own.mapInArrow(_decode(tokenizer_json(ranks_path)), "id bigint, ids array<int>, decoded binary, text string").withColumnRenamed("id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ids and decoded bytes."""
    return decoded.select(
        id_col, F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
