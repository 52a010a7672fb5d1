"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (byte_bpe, chat, collocation, conversation_repair, decontaminate, exact, html_text, quality, simhash,
                          substring, syncmers, token_files, toxicity)
from tidemark.llm.staging import staged
from tidemark.session import scratch_path

WORD_BPE, END_ID = public_tokenizers.path("word_bpe_49k.json"), 1
BYTE_RANKS, BYTE_PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in each document once windows of 13 words found in earlier documents are removed."""
    found = substring.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token shards of all documents, looked up by document key through the index; rows without key are scanned."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token-files")
    token_files.write_token_files(docs, folder, WORD_BPE, END_ID)
    found = token_files.read_token_files(docs, folder).unionByName(token_files.scan_token_files(spark, folder, null_keys_only=True))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document by positive-unlabelled learning."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: A conversation that says what the template's control strings are.
PLANTED = "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted, written, and digested from what the written output parses to."""
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.conversation_digests(staged(chat.format_conversations(turns), "chat"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity categories of each document by a classifier chain."""
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), *(c for c in found.columns if c.startswith("p_")),
                        F.col(f"p_{toxicity.LAST}").alias("score"), F.col("toxic").cast("int").alias("predicted"), "toxic")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page by its host's winning paths."""
    found = html_text.extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars"))


def byte_bpe_digests(docs: DataFrame) -> DataFrame:
    return byte_bpe.digests(byte_bpe.encode(docs, BYTE_RANKS, BYTE_PATTERN, decoded=True))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens of each document, and what they decode to."""
    return byte_bpe_digests(table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, and the document that stays of each."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in windows of benchmark items."""
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of two and three words that hold together best, for each language."""
    return collocation.mine_collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults, and the cheapest edits that mend them."""
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_digests(turns, conversation_repair.repair_conversations(conversation_repair.damage_turns(turns)))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how like they are to each other and the next document's."""
    found = syncmers.fingerprint_neighbours(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_token_files, op3_quality, op4_chat_format, op5_toxicity, op6_html_text, op7_byte_bpe,
    op8_simhash_dedup, op9_exact_dedup, op10_decontamination, op11_collocations, op12_conversation_repair, op13_fingerprints)}

SQL = {
    "op1_substring_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
                    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
        least AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
                 FROM windows JOIN least USING (win) WHERE first_id < doc_id),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
                 FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
    "op4_chat_format": r"""
        WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                       UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(4 + length(role) + 2 + length(text) + len(regexp_extract_all(text, '###|</turn>')) + 9)::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op10_decontamination": r"""
        WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
                         FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                               FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM item_windows),
        doc_windows AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
                        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
        words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
                  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)),
        counts AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
        sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
        cuts AS (SELECT c.lang, c.k, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS lp,
                        array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rp
                 FROM counts c, (VALUES (1), (2)) AS s(j) WHERE f >= 10 AND j < c.k),
        scored AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, j, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score
                   FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = lp JOIN counts y ON y.lang = cuts.lang AND y.phrase = rp),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inner_ones AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase, max(f) AS longest
                       FROM counts, (VALUES (1), (2)) AS s(i) WHERE k = 3 AND f >= 10 GROUP BY ALL),
        left_over AS (SELECT w.* FROM weakest w LEFT JOIN inner_ones o ON o.lang = w.lang AND o.phrase = w.phrase
                      WHERE longest IS NULL OR 100 * longest < 50 * a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over)
        SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
    "op9_exact_dedup": r"""
        WITH base AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM base WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)""",
}
