"""Exact dedup with a two-pass Bloom filter, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import staged
from tidemark.llm.words import SPACES

#: The filter has about this many cells for each row ...
CELLS_PER_ROW = 16
#: ... and at most so many in all: one bit a cell is broadcast, so 2**26 cells are 8 MB of bits in a million words.
MAX_CELLS = 1 << 26
#: A group of copies meets its result in this many tasks.
SALTS = 16


def squeezed(text: Column) -> Column:
    """Text without white space; null is empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for space in SPACES.decode():
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def _cell(seed: int, cells: int) -> Column:
    return F.pmod(F.xxhash64("text_key", F.lit(seed)), F.lit(cells))


def repeated_cells(keys: DataFrame, cells: int) -> DataFrame:
    """First pass: which of a Bloom filter's cells were hit at least twice, 64 cells to a row (word, bits).

    Each row hits two cells. Tasks add up their own hits before anything moves,
    so a text with very many copies costs two rows a task.
    """
    hits = keys.select(F.explode(F.array(_cell(1, cells), _cell(2, cells))).alias("cell"))
    twice = hits.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy((F.col("cell") / 64).cast("bigint").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits"))


def maybe_repeated(rows: DataFrame, words: DataFrame, cells: int) -> DataFrame:
    """Second pass: add ``maybe``, true where both cells of a row were hit twice or more."""
    small = F.broadcast(words)
    for seed in (1, 2):
        place = rows.withColumn(f"_cell{seed}", _cell(seed, cells))
        side = small.select(F.col("word").alias(f"_word{seed}"), F.col("bits").alias(f"_bits{seed}"))
        rows = place.join(side, (F.col(f"_cell{seed}") / 64).cast("bigint") == F.col(f"_word{seed}"), "left")
    hit = [F.coalesce(F.expr(f"shiftrightunsigned(_bits{s}, cast(_cell{s} % 64 as int)) & 1") == 1, F.lit(False))
           for s in (1, 2)]
    return rows.withColumn("maybe", hit[0] & hit[1]).drop(
        *(f"_{name}{s}" for name in ("cell", "word", "bits") for s in (1, 2)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                     max_cells: int = MAX_CELLS) -> DataFrame:
    """Group rows whose texts are equal without white space, and mark the one that stays.

    Returns (id, keep_id, group_size, kept, text_sha256) and the columns named in
    ``carry``: in a group the text with the most code points stays, then the
    smallest id. Equal means equal SHA-256 of the text without white space.

    How: the first pass counts the cells of a Bloom filter and keeps those hit
    twice; the second tests each row. A row that misses passes straight through
    with itself as group. Only the others are staged and shuffled: groups are
    added up in the tasks first, and results meet copies in 16 slices of the
    group. The filter's size follows the rows up to ``max_cells``, so its broadcast
    is bounded; beyond that more rows are tested exactly, with the same result.

    Null text is empty, so null and blank texts are one group. A null id counts as
    larger than any other. Of rows with the same id and text one stays; they all
    count. Columns not carried are ignored. An empty table gives no rows.
    """
    rows = docs.count()
    cells = min(max_cells, 1 << max(10, (CELLS_PER_ROW * rows - 1).bit_length()))
    text, carried = F.col(text_col), [f"_carry{i}" for i in range(len(carry))]
    named = docs.select(F.col(id_col).alias("own_id"), *(F.col(c).alias(n) for c, n in zip(carry, carried)),
                        F.coalesce(F.char_length(text.cast("string")), F.lit(0)).alias("points"),
                        F.sha2(squeezed(text), 256).alias("text_key"))
    words = staged(repeated_cells(docs.select(F.sha2(squeezed(text), 256).alias("text_key")), cells), "exact-filter")
    tested = maybe_repeated(named, words, cells)
    alone = tested.filter(~F.col("maybe")).select(
        "own_id", F.col("own_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_key", *carried)
    some = staged(tested.filter("maybe").select("own_id", "points", "text_key", F.monotonically_increasing_id().alias("uid"), *carried), "exact")
    best = some.groupBy("text_key").agg(
        F.min(F.struct(-F.col("points"), F.col("own_id").isNull(), "own_id", "uid")).alias("best"), F.count("*").alias("group_size"))
    sliced = best.select("text_key", F.col("best.own_id").alias("keep_id"), F.col("best.uid").alias("keep_uid"), "group_size",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    groups = some.withColumn("salt", F.pmod(F.col("uid"), F.lit(SALTS)).cast("int")).join(sliced, ["text_key", "salt"])
    met = groups.select("own_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_key", *carried)
    return alone.unionByName(met).select(
        F.col("own_id").alias(id_col), "keep_id", "group_size", "kept", F.col("text_key").alias("text_sha256"),
        *(F.col(n).alias(c) for c, n in zip(carry, carried)))
