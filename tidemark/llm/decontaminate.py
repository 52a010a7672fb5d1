"""Benchmark decontamination as a prefix-filtered set join of word shingles, verified word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, id_and_text, lists, pieces, staged, text_column, tidy, utf8
from tidemark.llm.words import alphanumeric_table, lower_ascii, window_hashes, window_rows, word_hashes, word_spans

WINDOW, SHINGLE = 10, 5
_BASE = 0x9FB21C651E98DF25
#: Hash bits that index the bitmap of wanted shingles: 2**24 bits are 2 MB, whatever the benchmark's size.
SIEVE_BITS = 24
#: A prefix row with its window text is about this large; the prefix table is broadcast up to MOST_BROADCAST bytes.
PREFIX_BYTES, MOST_BROADCAST = 300, 32 << 20
#: Bytes of text that a task cuts into words at once: several numbers are held for each word meanwhile.
READ_BYTES = 1 << 20


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, the words' starts and ends, each row's first word, and word hashes."""
    data, at = utf8(texts)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, at, alphanumeric_table())
    return data, starts, ends, first, word_hashes(data, starts, ends)


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    return window_hashes(hashes, width, _BASE + 2 * width)


def _item_windows(window: int, shingle: int):
    """Each shingle of each window of an item: (item, win, length, shift, width, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most_bytes=1 << 18):
                items = column(part, "id").to_pylist()
                data, starts, ends, first, hashes = _words(text_column(part))
                rows: dict[str, list] = {n: [] for n in ("item", "win", "length", "shift", "width", "h")}
                for i, item in enumerate(items):
                    low, high = int(first[i]), int(first[i + 1])
                    length = min(window, high - low)
                    width = min(shingle, length)
                    own = [data[a:b].tobytes().decode() for a, b in zip(starts[low:high], ends[low:high])]
                    marks = _shingles(hashes[low:high], width).view(np.int64) if length else ()
                    for k in range(high - low - length + 1 if length else 0):
                        for shift in range(length - width + 1):
                            for name, value in zip(rows, (item, " ".join(own[k:k + length]), length, shift, width, int(marks[k + shift]))):
                                rows[name].append(value)
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
                yield pa.record_batch({n: pa.array(v, k) for (n, v), k in zip(rows.items(), kinds)})

    return run


def _sieve(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the hashes' leading bits; at most 262,144 words come to the driver."""
    place = F.shiftrightunsigned("h", 64 - SIEVE_BITS)
    words = hashes.groupBy((place / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - SIEVE_BITS}) % 64 as int))")).alias("bits")).collect()
    table = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for row in words:
        table[row["word"]] = row["bits"]
    return table.view(np.uint8)


def _seen(sieve: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap has: packed bits, as a worker keeps it and the message it came in beyond its task, or a bool a place."""
    place = (h >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)
    if sieve.dtype == bool:
        return sieve[place]
    return (sieve[place >> 3] >> (place & 7).astype(np.uint8) & 1).view(bool)


def _counts(widths: list[int], sieve: np.ndarray):
    """How often each wanted shingle occurs, added up within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most_bytes=READ_BYTES):
                *_, first, hashes = _words(text_column(part))
                for width in widths:
                    h = _shingles(hashes, width)[window_rows(first, width)[0]]
                    values, n = np.unique(h[_seen(sieve, h)], return_counts=True)
                    yield pa.record_batch({"h": pa.array(values.view(np.int64)), "width": pa.array(np.full(len(n), width, np.int32)),
                                           "n": pa.array(n.astype(np.int64))})

    return run


def _candidates(widths: list[int], sieve: np.ndarray, reach: int, ahead: int):
    """One row for each document: its words' number, and where prefix shingles may stand, with the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most_bytes=READ_BYTES):
                data, starts, ends, first, hashes = _words(text_column(part))
                found_h, found_w, found_row, found_at = [], [], [], []
                for width in widths:
                    begin, row = window_rows(first, width)
                    h = _shingles(hashes, width)[begin]
                    hit = _seen(sieve, h)
                    found_h.append(h[hit])
                    found_w.append(np.full(hit.sum(), width, np.int32))
                    found_row.append(row[hit])
                    found_at.append(begin[hit])
                row = np.concatenate([np.zeros(0, np.int64), *found_row])
                order = np.argsort(row, kind="stable")
                row, at = row[order], np.concatenate([np.zeros(0, np.int64), *found_at])[order]
                h, w = np.concatenate([np.zeros(0, np.uint64), *found_h])[order], np.concatenate([np.zeros(0, np.int32), *found_w])[order]
                low = np.maximum(at - reach, first[row])
                high = np.minimum(at + ahead, first[row + 1])
                around = [" ".join([data[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j])]) for i, j in zip(low, high)]
                last = np.searchsorted(row, np.arange(part.num_rows), side="right")
                yield pa.record_batch({
                    "uid": column(part, "uid"), "id": column(part, "id"), "n_words": pa.array(np.diff(first).astype(np.int64)),
                    "h": lists(h.view(np.int64), last, pa.int64()), "width": lists(w, last, pa.int32()),
                    "pos": lists(at - first[row], last, pa.int64()), "lead": lists(at - low, last, pa.int64()),
                    "around": lists(np.array(around, object), last, pa.string())})

    return run


def prefixes(docs: DataFrame, shingles: DataFrame, widths: list[int]) -> DataFrame:
    """Of each window the shingle that is rarest in the documents: (win, length, h, width, shift).

    An occurring window holds all its shingles, so a prefix of one token is enough.
    """
    counts = docs.mapInArrow(tidy(_counts(widths, _sieve(shingles))), "h bigint, width int, n bigint").groupBy("h", "width").agg(
        F.sum("n").alias("n"))
    ranked = shingles.join(counts, ["h", "width"], "left")
    order = F.struct(F.coalesce("n", F.lit(0)), "h", "shift", "width").alias("rarest")
    return ranked.groupBy("win", "length").agg(F.min(order).alias("rarest")).select(
        "win", "length", "rarest.h", "rarest.width", "rarest.shift")


def _sorted_digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items.cast("array<string>")), ","), 256)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Words of each document that lie in windows of ``window`` words of a benchmark item.

    Returns one row for each row of docs: (id, n_words, n_hit, hit_positions, items).
    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
    characters. An item with fewer words is one window; one without words has none.

    How: every window is cut into ``shingle``-word shingles, whose occurrences are
    counted over all documents; the rarest one is the window's prefix. Documents
    look their shingles up in a bitmap of prefixes and emit the few that may
    match with the words around them; these join the prefix table on the hash.
    The window must fit into the document at that place (length and positional bounds) and
    its words must be equal (verification), so hash collisions don't matter. Texts never
    move. The prefix table is broadcast if its counted rows make at most 32 MB, else joined by
    shuffle, where adaptive execution splits a frequent hash.

    Null texts have no words. A null id gets its row like any other; rows with one
    id get a row each. An item with null id hits words but isn't listed; repeated
    items are listed once. Other columns are ignored. An empty benchmark hits nothing.
    """
    own = id_and_text(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    shingles = staged(id_and_text(benchmark, item_col, item_text_col).mapInArrow(
        _item_windows(window, shingle), "item bigint, win string, length int, shift int, width int, h bigint"), "benchmark")
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect())  # at most ``shingle`` of them
    tokens = staged(prefixes(own, shingles.drop("item").distinct(), widths), "prefixes")
    places = own.mapInArrow(tidy(_candidates(widths, _sieve(tokens), window - 1, window)), (
        "uid bigint, id bigint, n_words bigint, h array<bigint>, width array<int>, pos array<bigint>, lead array<bigint>, around array<string>"))
    each = places.select("uid", "id", "n_words", F.inline_outer(F.arrays_zip("h", "width", "pos", "lead", "around")))
    # A document without candidates meets no prefix; its own key keeps such rows apart.
    each = each.withColumn("h", F.coalesce("h", "uid"))
    small = tokens.count() * PREFIX_BYTES <= MOST_BROADCAST
    side = tokens.withColumnRenamed("h", "token").withColumnRenamed("width", "token_width")
    met = each.join(F.broadcast(side) if small else side, (F.col("h") == F.col("token")) & (F.col("width") == F.col("token_width")), "left")
    start = F.col("pos") - F.col("shift")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    same = F.slice(F.split("around", " "), (F.col("lead") - F.col("shift") + 1).cast("int"), F.col("length")) == F.split("win", " ")
    hit = met.select("uid", "id", "n_words", start.alias("start"), "length", "win",
                     F.when(fits, F.when(same, True)).alias("found"))
    # Per document and window first, then per document: positions, and the windows' items.
    of_items = shingles.select("win", "item").distinct().groupBy("win").agg(F.collect_set("item").alias("items"))
    if small:
        of_items = F.broadcast(of_items)
    spans = F.when(F.col("found"), F.sequence("start", F.col("start") + F.col("length") - 1))
    per_window = hit.withColumn("win", F.when(F.col("found"), F.col("win"))).groupBy("uid", "id", "n_words", "win").agg(
        F.array_distinct(F.flatten(F.collect_list(spans))).alias("positions"))
    listed = per_window.join(of_items, "win", "left")
    return listed.groupBy("uid", "id", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("hit_positions"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).select(
        F.col("id").alias(id_col), "n_words", F.size("hit_positions").cast("bigint").alias("n_hit"), "hit_positions", "items")


def digests(hits: DataFrame) -> DataFrame:
    """The columns of the report: items by number and by digest of their sorted names."""
    return hits.select("*", F.size("items").cast("bigint").alias("n_items"), _sorted_digest(F.col("items")).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))
