"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer is k bytes of the text. It is kept if the least hash among its inner stretches of s bytes stands at its first or
last place. Whether a k-mer is kept depends on nothing but its own bytes, so equal stretches of any two texts keep equal
anchors, wherever they stand. An edited text therefore takes over the anchors of the parts it is made of.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import shuffle_width

#: Bytes of a k-mer and of its inner stretches: 2 of 17 k-mers are kept on average.
K, S = 24, 8
#: Bytes of a text whose stretches are hashed together.
STRETCH = 1 << 14
#: Ranges of ids that a task gets, on average.
RANGES_PER_TASK = 4
_INNER_SEED, _ANCHOR_SEED = 11, 29


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _least_ahead(h: Column, length: int, use: Callable[[Column], Column]) -> Column:
    """``use`` of the least of each value and the ``length - 1`` behind it, from stretches of 1, 4, 16, ... values."""
    def step(values: Column, span: int) -> Column:
        if span >= length:
            return use(values)
        wider = min(4 * span, length)
        offsets = sorted({min(o, wider - span) for o in (span, 2 * span, 3 * span)})
        least = F.transform(values, lambda x, i: F.least(x, *(F.get(values, i + o) for o in offsets)))
        return _bound(least, lambda made: step(made, wider))
    return step(h, 1)


def _kept(part: Column, k: int, s: int) -> Column:
    """Places (from 0) of the kept k-mers of one stretch of bytes that is at least k long."""
    last = k - s
    hashes = F.transform(F.sequence(F.lit(1), F.octet_length(part) - (s - 1)), lambda i: F.xxhash64(F.substring(part, i, s), F.lit(_INNER_SEED)))
    # The last of the inner hashes is no larger than itself, so the others are enough to compare with.
    return _bound(hashes, lambda h: _least_ahead(h, last, lambda low: F.filter(
        F.transform(low, lambda m, i: F.when(F.get(h, i + last).isNotNull() & (F.least(F.get(h, i), F.get(h, i + last)) <= m), i)),
        lambda i: i.isNotNull())))


def kept_anchors(body: Column, k: int = K, s: int = S) -> Column:
    """struct<at: array<int>, hash: array<bigint>>: where the kept k-mers of some bytes begin (from 0, in order), and their hashes.

    Long texts are cut into stretches that overlap by a k-mer less a byte: each k-mer lies in exactly one of them.
    """
    if not 0 < s < k:
        raise ValueError("inner stretches must be shorter than k")
    def of(data: Column) -> Column:
        stretches = F.transform(F.sequence(F.lit(0), F.octet_length(data) - k, F.lit(STRETCH)), lambda low: F.transform(
            _bound(F.substring(data, low + 1, STRETCH + k - 1), lambda part: _kept(part, k, s)), lambda i: low + i))
        places = F.when(F.octet_length(data) >= k, F.flatten(stretches)).otherwise(F.array().cast("array<int>"))
        return _bound(places, lambda at: F.struct(
            at.alias("at"), F.transform(at, lambda i: F.xxhash64(F.substring(data, i + 1, k), F.lit(_ANCHOR_SEED))).alias("hash")))
    return _bound(body, of)


def _whole(marks: Column, text: Column) -> Column:
    """A text without any kept k-mer, such as one shorter than k, is one anchor as a whole; an empty text has none."""
    one = F.struct(F.array(F.lit(0)).alias("at"), F.array(F.xxhash64(F.encode(text, "UTF-8"), F.lit(_ANCHOR_SEED))).alias("hash"))
    return F.when((F.size(marks["at"]) > 0) | (F.octet_length(text) == 0), marks).otherwise(one)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """struct<at: array<int>, hash: array<bigint>>: a text's anchors: its kept k-mers, or the whole text where there are none."""
    return _bound(kept_anchors(F.encode(text, "UTF-8"), k, s), lambda marks: _whole(marks, text))


def joined_anchors(head: Column, head_marks: Column, tail: Column, tail_marks: Column, k: int = K, s: int = S) -> Column:
    """The kept anchors of two texts one after another, from those of longer texts that begin with ``head`` and with ``tail``.

    K-mers within either part are kept there as here; only the 2 * k - 2 bytes around the joint are looked at again.
    """
    cut, size = F.octet_length(head), F.octet_length(tail)
    joint = F.concat(F.substring(F.encode(F.substring(head, -(k - 1), k - 1), "UTF-8"), -(k - 1), k - 1),
                     F.substring(F.encode(F.substring(tail, 1, k - 1), "UTF-8"), 1, k - 1))

    def within(marks: Column, length: Column) -> Column:
        """How many anchors lie in the first bytes: places ascend."""
        return F.size(F.filter(marks["at"], lambda at: at + k <= length))

    def made(middle: Column) -> Column:
        parts = [(head_marks, within(head_marks, cut), F.lit(0)), (tail_marks, within(tail_marks, size), cut)]
        at, hashes = ([F.slice(marks[name], 1, n) for marks, n, _ in parts] for name in ("at", "hash"))
        return F.struct(F.concat(at[0], F.transform(middle["at"], lambda i: i + cut - F.least(cut, F.lit(k - 1))),
                                 F.transform(at[1], lambda i: i + cut)).alias("at"),
                        F.concat(hashes[0], middle["hash"], hashes[1]).alias("hash"))

    return _bound(kept_anchors(joint, k, s), made)


def digits(marks: Column) -> Column:
    """A fingerprint's text: 8 hex digits of each anchor's hash, in order (31 bits of it; the first bit is set)."""
    return F.lower(F.array_join(F.transform(marks["hash"], lambda h: F.hex(h.bitwiseAND(F.lit(0x7FFFFFFF)).bitwiseOR(F.lit(0x80000000)))), ""))


def occurrences(marks: Column) -> Column:
    """array<bigint>: a number for the first (the hash itself), second, ... occurrence of each anchor's hash, so that repeats count."""
    def numbered(ordered: Column) -> Column:
        begins = F.filter(F.transform(ordered, lambda x, i: F.when((i == 0) | (F.get(ordered, i - 1) != x), i)), lambda i: i.isNotNull())
        return _bound(begins, lambda at: F.flatten(F.transform(at, lambda low, j: F.transform(
            F.sequence(low, F.coalesce(F.get(at, j + 1), F.size(ordered)) - 1),
            lambda i: F.when(i == low, F.get(ordered, low)).otherwise(F.xxhash64(F.get(ordered, low), i - low))))))

    return _bound(marks["hash"], lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), h).otherwise(_bound(F.array_sort(h), numbered)))


def likeness(a: Column, b: Column) -> Column:
    """The share of two texts' anchors, repeats counted, that both have: 2 * |both| / (|a| + |b|), and 1 for two empty texts.

    ``a`` and ``b`` are ``occurrences`` of their anchors.
    """
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def matched(pairs: DataFrame, a: str, b: str, keep: tuple[str, ...]) -> DataFrame:
    """(keep..., at_a, at_b): where two fingerprints have equal anchors; at_a - at_b tells how far a passage has moved.

    ``a`` and ``b`` are columns of anchors. Each row's anchors meet those of the same row only, through a join on row and
    hash. An anchor that repeats in both texts is matched at its first place in each.
    """
    own = pairs.select(*keep, a, b).withColumn("_row", F.monotonically_increasing_id())
    side = {n: own.select("_row", *(keep if n == a else ()), F.inline(F.arrays_zip(F.col(f"{n}.at"), F.col(f"{n}.hash")))).groupBy("_row", *(keep if n == a else ()), "hash").agg(F.min("at").alias(f"at_{n}"))
            for n in (a, b)}
    return side[a].join(side[b], ["_row", "hash"]).select(*keep, F.col(f"at_{a}").alias("at_a"), F.col(f"at_{b}").alias("at_b"))


# ------------------------------------------------------------------------------------------------ neighbours in id order

@dataclass(frozen=True)
class Ranges:
    """Where ranges of rows by (id, text hash) begin; ``firsts`` are keys of rows."""

    firsts: list[tuple[int | None, int]]

    def _table(self) -> Column:
        ids, hashes = F.array(*(F.lit(i).cast("bigint") for i, _ in self.firsts)), F.array(*(F.lit(h).cast("bigint") for _, h in self.firsts))
        return F.arrays_zip(ids.alias("id"), hashes.alias("h"))

    def number(self, key: Column) -> Column:
        """The number (from 0) of the range that a key lies in, by halving."""
        table, n = self._table(), len(self.firsts)
        steps = F.array(*(F.lit(1 << b) for b in reversed(range(max(1, n.bit_length())))))
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step < n) & F.coalesce(F.get(table, at + step) <= key, F.lit(False)), at + step).otherwise(at))

    def begins(self, key: Column, number: Column) -> Column:
        return F.get(self._table(), number) == key


def _key(id_name: str = "id", hash_name: str = "h") -> Column:
    return F.struct(F.col(id_name).alias("id"), F.col(hash_name).alias("h"))


def id_ranges(rows: DataFrame, count: int) -> Ranges:
    """About ``count`` ranges with as many rows each; their first keys come to the driver, one a range."""
    spread = rows.select("id", "h").repartitionByRange(count, "id", "h").groupBy(F.spark_partition_id().alias("part")).agg(F.min(_key()).alias("first"))
    return Ranges(sorted(((r["first"]["id"], r["first"]["h"]) for r in spread.collect()), key=lambda k: (k[0] is not None, k)))


def _with_columns(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step)
    return df


def with_next(rows: DataFrame, columns: tuple[str, ...], make: list[dict[str, Column]]) -> DataFrame:
    """Add ``next_*`` of the named columns: their values in the next row by (id, h); after the last comes the first.

    ``make`` are columns, step by step, that are added where rows lie in order, before the next one is looked up. Rows move once: they are dealt
    to ranges, and a range's first row also goes to the range before, behind all rows there.
    """
    width = shuffle_width(rows.sparkSession)
    ranges = id_ranges(rows, RANGES_PER_TASK * width)
    n = len(ranges.firsts)
    if not n:
        made = _with_columns(rows, make)
        return made.withColumns({f"next_{c}": F.col(c) for c in columns})
    own = rows.withColumn("range", ranges.number(_key()))
    places = F.when(ranges.begins(_key(), F.col("range")), F.array(
        F.struct(F.col("range").alias("at"), F.lit(False).alias("guest")),
        F.struct(F.pmod(F.col("range") - 1, F.lit(n)).alias("at"), F.lit(True).alias("guest")))).otherwise(F.array(
            F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))))
    dealt = (own.withColumn("place", F.explode(places)).withColumns({"at": F.col("place.at"), "guest": F.col("place.guest")}).drop("place", "range")
             .repartition(width, "at").sortWithinPartitions("at", "guest", "id", "h"))
    order = Window.partitionBy("at").orderBy("guest", "id", "h")
    made = _with_columns(dealt, make)
    return made.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).filter(~F.col("guest")).drop("at", "guest")


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """(id, n_chars, edited, anchors, edited_anchors, fingerprint, edited_fingerprint, near_edited, near_next).

    Each text is fingerprinted, and so is its edited form: its last quarter of code points (rounded down) replaced by as
    many, or all, of the beginning of the next document's text. ``near_edited`` and ``near_next`` are the likeness of its
    anchors to the edited text's and to the next document's.

    How: texts move once, dealt by ranges of (id, hash of the text) and sorted there; anchors are made in place, whole texts in
    bounded stretches. An edited text takes over the anchors within its two parts. Everything is built-in functions, no Python
    runs over rows.

    The order is ascending id, nulls first, then the text's hash; after the last comes the first, and a single row is its own
    next. Null text is empty. Rows equal in id and text lie in one task. Other columns are ignored. An empty table gives no rows.
    """
    text, kept, next_kept = F.col("text"), F.col("kept"), F.col("next_kept")
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = own.withColumn("h", F.xxhash64("text"))
    met = with_next(keyed, ("text", "kept", "marks"), [
        {"n_chars": F.char_length("text").cast("bigint"), "kept": kept_anchors(F.encode(text, "UTF-8"), k, s)}, {"marks": occurrences(_whole(kept, text))}])
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    cut = met.withColumns({"head": F.substring(text, F.lit(1), F.col("n_chars").cast("int") - quarter),
                           "tail": F.substring(F.col("next_text"), F.lit(1), quarter)})
    both = cut.select("id", "n_chars", "marks", "next_marks", F.concat("head", "tail").alias("edited"), _whole(kept, text).alias("anchors"),
                      joined_anchors(F.col("head"), kept, F.col("tail"), next_kept, k, s).alias("joined"))
    marked = both.withColumn("edited_anchors", _whole(F.col("joined"), F.col("edited"))).withColumn("edited_marks", occurrences(F.col("edited_anchors")))
    return marked.select(
        F.col("id").alias(id_col), "n_chars", "edited", "anchors", "edited_anchors", digits(F.col("anchors")).alias("fingerprint"),
        digits(F.col("edited_anchors")).alias("edited_fingerprint"), likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
