"""Phrase collocation mining: Misra-Gries summaries find all phrases that can be frequent, a second pass counts those exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, pieces, shuffle_width, staged, text_column, tidy, utf8
from tidemark.llm.words import lower_ascii, mix, window_hashes, word_hashes, word_spans
from tidemark.operators.ordered import top_k

LEAST, MOST_WORDS, TOP, INSIDE_PERCENT = 10, 3, 2000, 50
#: What ends a piece of text, what parts words in it, and the name of a missing language.
BREAKS, BLANKS, NO_LANG = b".,;:!?\n\x0b\x0c\r", b" \t", "und"
#: Text of a hash partition, at most about so many bytes: its summary takes about half as many.
PARTITION_BYTES = 256 << 20
#: Text looked at together, and phrases held by a task before they are handed on.
_TEXT, _HELD = 2 << 20, 2 << 20
#: Bits of the filter for each survivor, and at most in all: 2**27 bits are 16 MB, whatever the number of survivors.
BITS_PER_SURVIVOR, MOST_BITS = 16, 1 << 27
#: Parts of phrases are looked up in so many slices.
SALTS = 8
_BASE = 0xC2B2AE3D27D4EB4F
#: Factors that spread partitions (below 2**31) and keys (below 2**32) over the bitmap; sums stay below 2**63.
_SPREAD = (0x1E3779B1, 0x45EBCA77)


# ------------------------------------------------------------------------------------------------ words and phrases

def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and which end a piece."""
    ends = np.zeros(256, bool)
    ends[list(BREAKS)] = True
    inside = ~ends
    inside[list(BLANKS)] = False
    return inside, ends


class Phrases:
    """The words of some texts, and which phrases of 1, 2, ... words lie within one piece."""

    def __init__(self, texts: pa.Array, most_words: int):
        data, at = utf8(texts)
        self.data = lower_ascii(data)
        inside, ends = _tables()
        self.starts, self.ends, first = word_spans(self.data, at, inside)
        n = len(self.starts)
        #: Whether a word and the next lie in one piece of one text.
        linked = np.zeros(n, bool)
        if n:
            piece = np.cumsum(ends[self.data], dtype=np.int64)[self.starts]
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            linked[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        self.counts = np.diff(first)
        self.begins = [np.arange(n)]
        for _ in range(1, most_words):
            begin = self.begins[-1]
            width = len(self.begins)
            self.begins.append(begin[linked[begin + width - 1]])

    def hashes(self, seeds: np.ndarray) -> list[np.ndarray]:
        """For each length, a hash of every phrase with its text's seed."""
        words, seed = word_hashes(self.data, self.starts, self.ends), np.repeat(seeds, self.counts)
        return [mix(window_hashes(words, k, _BASE)[begin] ^ seed[begin] ^ np.uint64(k)) for k, begin in enumerate(self.begins, 1)]


def _langs(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct languages, each row's number among them, and each row's seed for hashes."""
    coded = column(part, "lang").dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    seeds = np.array([xxhash.xxh64_intdigest(lang.encode()) for lang in coded.dictionary.to_pylist()], np.uint64)
    return coded.dictionary, number, seeds[number]


def _own(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))


# ------------------------------------------------------------------------------------------------ summaries

class Summary:
    """A Misra-Gries summary: at most ``capacity`` keys with counts that are too small by ``missed`` at most.

    ``missed`` is at most the mass added divided by (capacity + 1). Summaries of parts of the data merge into one of the
    whole with the same bound.
    """

    def __init__(self, capacity: int):
        self.capacity, self.missed = max(1, capacity), 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((keys, counts))
        self.size += len(keys)
        if self.size > self.capacity + (1 << 16):
            self.fold()

    def merge(self, other: Summary) -> None:
        other.fold()
        self.missed += other.missed
        self.add(other.keys, other.counts)

    def fold(self) -> None:
        """Add up what is held; of more keys than there is room for, all counts sink by the largest that finds no room."""
        keys = np.concatenate([self.keys, *(k for k, _ in self.held)])
        counts = np.concatenate([self.counts, *(c for _, c in self.held)])
        self.held, self.size = [], 0
        keys, counts = added_up(keys, counts)
        if len(keys) > self.capacity:
            sink = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            stay = counts > sink
            keys, counts = keys[stay], counts[stay] - sink
            self.missed += int(sink)
        self.keys, self.counts = keys, counts

    def possible(self, least: int) -> np.ndarray:
        """Every key that can have been added ``least`` times, if capacity is at least mass / least."""
        self.fold()
        return self.keys[self.counts + self.missed >= least]


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, byte by byte of all: the high bytes are mostly zero and compress."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


_PACKED = {"bucket": pa.int32(), "mass": pa.int64(), "once": pa.binary(), "often": pa.binary(), "counts": pa.binary()}


def _summarised(most_words: int, parts: int):
    """A task's phrases, counted in bounded portions: for each hash partition their mass, and packed keys with counts."""

    def portion(held: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate([_dealt(h, parts) for h in held])
        both.sort()
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        counts = np.diff(np.append(first, len(both)))
        bucket, key = (both[first] >> np.uint64(32)).astype(np.int64), both[first].astype(np.uint32)
        edges = np.searchsorted(bucket, np.arange(parts + 1))
        rows: list[tuple] = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own_keys, own_counts = key[edges[b]:edges[b + 1]], counts[edges[b]:edges[b + 1]]
            one = own_counts == 1
            rows.append((b, int(own_counts.sum()), None, None, None))
            rows.append((b, None, pack_sorted(own_keys[one]), pack_sorted(own_keys[~one]), own_counts[~one].astype("<i8").tobytes()))
        return pa.record_batch({n: pa.array(c, t) for (n, t), c in zip(_PACKED.items(), zip(*rows))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in pieces(batch, most_bytes=_TEXT):
                for h in Phrases(text_column(part), most_words).hashes(_langs(part)[2]):
                    held.append(h)
                    size += len(h)
                if size >= _HELD:
                    yield portion(held)
                    held, size = [], 0
        if size:
            yield portion(held)

    return run


def _dealt(h: np.ndarray, parts: int) -> np.ndarray:
    """Partition and key in one number."""
    bucket, key = partition_and_key(h, parts)
    return (bucket.astype(np.uint64) << np.uint64(32)) | key


def partition_and_key(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The upper half of a hash deals it to its partition, the lower half is its key there."""
    upper = (h >> np.uint64(32)).astype(np.int64)
    return (upper * parts) >> 32, (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _survivors(least: int):
    """Rows come ordered by hash partition, masses first: merge the summaries, and return the keys that can be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, mass, summary = None, 0, None

        def close() -> pa.RecordBatch:
            keys = (summary.possible(least) if summary else np.zeros(0, np.uint32)).astype(np.int64)
            return pa.record_batch({"bucket": pa.array(np.full(len(keys), bucket, np.int32)), "key": pa.array(keys)})

        for batch in batches:
            for b, m, once, often, counts in zip(*(column(batch, n).to_pylist() for n in _PACKED)):
                if b != bucket:
                    if bucket is not None:
                        yield close()
                    bucket, mass, summary = b, 0, None
                if m is not None:
                    mass += m
                    continue
                # Capacity exceeds mass / least, so no key that occurs ``least`` times sinks below zero.
                summary = summary or Summary(mass // least + 1)
                one = unpack_sorted(once)
                summary.add(one, np.ones(len(one), np.int64))
                summary.add(unpack_sorted(often), np.frombuffer(counts, "<i8"))
        if bucket is not None:
            yield close()

    return run


def possible_phrases(own: DataFrame, least: int, most_words: int) -> tuple[DataFrame, int]:
    """(bucket, key) of every phrase that can occur ``least`` times in its language, and the number of hash partitions."""
    width = shuffle_width(own.sparkSession)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(width, size // PARTITION_BYTES)
    packed = own.mapInArrow(tidy(_summarised(most_words, parts)), "bucket int, mass bigint, once binary, often binary, counts binary")
    dealt = packed.repartitionById(parts, "bucket").sortWithinPartitions("bucket", F.col("mass").isNull())
    return staged(dealt.mapInArrow(tidy(_survivors(least)), "bucket int, key bigint"), "collocation-possible"), parts


# ------------------------------------------------------------------------------------------------ exact counts

def _filter_bits(possible: DataFrame, most_bits: int) -> tuple[np.ndarray, int]:
    """A bitmap of the survivors, sized by their number up to ``most_bits``: beyond that more phrases pass and are counted."""
    count = possible.count()
    bits = min(most_bits, 1 << max(10, (BITS_PER_SURVIVOR * max(1, count) - 1).bit_length()))
    cell = F.col("bucket").cast("bigint") * F.lit(_SPREAD[0]) + F.col("key") * F.lit(_SPREAD[1])
    cell = F.pmod(cell.bitwiseXOR(F.shiftrightunsigned(cell, 29)), F.lit(bits))
    words = possible.select(cell.alias("cell")).groupBy((F.col("cell") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits")).toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table, bits


def _cells(bucket: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """As in ``_filter_bits``."""
    cell = bucket * _SPREAD[0] + key.astype(np.int64) * _SPREAD[1]
    return (cell ^ (cell >> 29)) % bits


def _counted(most_words: int, parts: int, table: np.ndarray, bits: int):
    """Phrases that pass the filter, told apart by their words and counted within each part of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most_bytes=_TEXT):
                own, (langs, lang, seeds) = Phrases(text_column(part), most_words), _langs(part)
                if not len(own.starts):
                    continue
                lang = np.repeat(lang, own.counts)
                sizes = np.bincount(lang, minlength=len(langs))
                yield _listed(langs, pa.array([""] * len(langs)), 0, sizes)
                coded = _word_array(own).dictionary_encode()
                number, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
                # A number for each distinct phrase at the places where it begins, -1 where none can be frequent. Phrases
                # are numbered by their first words' number and the last word; the language is the first of all.
                ids = lang
                for k, (begin, h) in enumerate(zip(own.begins, own.hashes(seeds)), 1):
                    at = _cells(*partition_and_key(h, parts), bits)
                    begin = begin[((table[at >> 6] >> (at & 63)) & 1 == 1) & (ids[begin] >= 0)]
                    if not len(begin):
                        break
                    _, first, dense, count = np.unique(ids[begin] * len(words) + number[begin + k - 1],
                                                       return_index=True, return_inverse=True, return_counts=True)
                    ids = np.full(len(number), -1)
                    ids[begin] = dense
                    chosen = begin[first]
                    said = [words.take(pa.array(number[chosen + j])) for j in range(k)]
                    phrase = pc.binary_join_element_wise(*said, " ") if k > 1 else said[0]
                    yield _listed(langs.take(pa.array(lang[chosen])), phrase, k, count)

    return run


def _listed(lang: pa.Array, phrase: pa.Array, words: int, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"lang": lang, "phrase": phrase, "words": pa.array(np.full(len(n), words, np.int32)), "n": pa.array(n.astype(np.int64))})


def _word_array(own: Phrases) -> pa.Array:
    """The words as one Arrow column: their bytes side by side."""
    size = (own.ends - own.starts).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(at[-1]) - np.repeat(at[:-1] - own.starts, size)
    body = pa.py_buffer(own.data[place].tobytes())
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(at.astype(np.int32).tobytes()), body])


def count_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, text_col: str = "text", lang_col: str = "lang",
                  most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, phrase, words, n): every phrase of 1 to ``most_words`` words that occurs ``least`` times or more in its language,
    counted exactly, and for each language with words one row without phrase (words is 0) that has the number of all words.

    How: in a first pass each task counts hashed phrases in bounded portions and packs them by hash partition. Each
    partition merges these into one Misra-Gries summary whose capacity exceeds the partition's mass divided by ``least``, so no
    frequent phrase is lost. The survivors make a bitmap of bounded size. In the second pass, phrases that pass it are counted
    by their words, first within some megabytes of text, then per task, then over all; rare ones that slipped through go.

    Null text is empty; a null language is ``und``. Repeated rows count each time. Other columns are ignored. An empty table
    gives no rows.
    """
    own = _own(docs, text_col, lang_col)
    possible, parts = possible_phrases(own, least, most_words)
    table, bits = _filter_bits(possible, most_bits)
    counted = own.mapInArrow(tidy(_counted(most_words, parts, table, bits)), "lang string, phrase string, words int, n bigint")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("words") == 0))


# ------------------------------------------------------------------------------------------------ scores

def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals; counts must be below 10**16."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    top = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(32,0)"))


def _looked_up(rows: DataFrame, counts: DataFrame, part: str, out: str) -> DataFrame:
    """Add the count of a phrase's part; a part of very many phrases is met in slices."""
    sliced = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(out),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_slice"))
    return rows.join(sliced, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")) & (F.col("slice") == F.col("_slice"))).drop(
        "_lang", "_part", "_slice", part)


def _spans(length: int) -> Column:
    """The distinct stretches of ``length`` words of a phrase."""
    at = F.sequence(F.lit(1), F.col("words") - length + 1)
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(F.split("phrase", " "), i, length), " ")))


def score_phrases(counts: DataFrame, most_words: int = MOST_WORDS, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of phrases of two words and more, by their weakest cut; ``counts`` must be written.

    A phrase goes whose words lie in a longer one that occurs at least ``inside_percent`` % as often.
    """
    named = counts.filter("words > 0")
    long = named.filter("words > 1").withColumnRenamed("n", "a")
    each = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumn(
        "slice", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    cut = each.withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - words)")})
    both = _looked_up(_looked_up(cut, named, "first", "l"), named, "rest", "r")
    weakest = both.select("lang", "phrase", "words", "a", F.struct(cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r").alias("w"))
    scored = weakest.groupBy("lang", "phrase", "words", "a").agg(F.min("w").alias("w"))
    inner = [long.filter(F.col("words") > length).select("lang", F.explode(_spans(length)).alias("inner"), "a") for length in range(2, most_words)]
    if inner:
        held = reduce(DataFrame.unionByName, inner).groupBy("lang", "inner").agg(F.max("a").alias("longest"))
        gone = held.select(F.col("lang").alias("_lang"), F.col("inner").alias("_inner"), "longest")
        scored = scored.join(gone, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner"))
                             & (F.col("longest").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * inside_percent), "left_anti")
    return scored.select("lang", "phrase", "words", "a", "w.l", "w.r", "w.score")


def mine_collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, top: int = TOP, text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``most_words`` words.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words; a phrase
    lies within one piece and occurs ``least`` times or more. Its score is floor(1000000 * a * a / (l * r)) of the cut where that
    is least, then of the first such cut: a, l and r count the phrase and its two parts, n all words. Ties in rank go to the more
    frequent phrase, then by the bytes of the phrase. ``top`` is a feature: the length of the report. See ``count_phrases`` and
    ``score_phrases`` for how counts are made, nulls and limits.
    """
    counts = staged(count_phrases(docs, least, most_words, text_col, lang_col), "collocation-counts")
    best = top_k(score_phrases(counts, most_words), ["lang"], [F.desc("score"), F.desc("a"), "phrase"], top)
    sizes = counts.filter("words = 0").select(F.col("lang").alias("_lang"), "n")
    return best.join(sizes, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
