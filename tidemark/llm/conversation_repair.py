"""Conversation repair: weighted CYK parsing of row spans, so that roles read as an optional system turn and user/assistant pairs.

Faults are found with DataFrame functions on rows without their texts. A conversation's rows then are a string of
symbols, cut into segments wherever Spark's sorted partitions cut it; each segment is parsed where it lies, and the
segments' cells are combined to the conversation's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, pieces, shuffle_width, staged, text_column

#: The initials that the grammar knows, other initials, and the same for rows that must go and for truncated rows.
INITIALS, DOOMED, TRUNCATED = "suao", "1234", "SUAO"
USER, ASSISTANT = "user", "assistant"
#: Characters that a blank text consists of, and those that end a whole one.
_INK, _ENDS = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
#: Rows of a segment, at about this many; slices of a repeated text's group; bytes of text handed on together.
SEGMENT, SALTS, _PART = 4096, 16, 1 << 20


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


# ------------------------------------------------------------------------------------------------ the grammar
#
# A symbol of the grammar stands for all pieces of s?(ua)+ with one first and one last role: E is the empty piece, M the
# system turn alone, UA (user ... assistant) and so on. A rule X -> Y Z says that a Y and a Z side by side make an X. These
# are Chomsky normal form rules; E, UA and MA are whole conversations.

SYMBOLS = ("E", "M", "UU", "UA", "AU", "AA", "MU", "MA")
WHOLE = tuple(SYMBOLS.index(s) for s in ("E", "UA", "MA"))


def _rules() -> tuple[tuple[int, int, int], ...]:
    after, rules = {"M": "U", "U": "A", "A": "U"}, []
    for i, left in enumerate(SYMBOLS):
        for j, right in enumerate(SYMBOLS):
            if left == "E" or right == "E":
                rules.append((i, j, j if left == "E" else i))
            elif right[0] == after[left[-1]]:
                rules.append((i, j, SYMBOLS.index(left[0] + right[-1])))
    return tuple(rules)


RULES = _rules()
#: A cell holds for each symbol the least (cost, audit) of a span, or None.
Cell = tuple


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side.

    Audits of one span and cost have the same edits of rows and the same number of insertions, so none is the beginning of
    another, and the least whole is made of least parts.
    """
    best: list = [None] * len(SYMBOLS)
    for i, j, k in RULES:
        a, b = left[i], right[j]
        if a and b:
            cost, now = a[0] + b[0], best[k]
            if not now or cost <= now[0]:
                made = (cost, a[1] + b[1])
                if not now or made < now:
                    best[k] = made
    return tuple(best)


def _least(a: Cell, b: Cell) -> Cell:
    return tuple(min(x, y) if x and y else x or y for x, y in zip(a, b))


@lru_cache(maxsize=8)
def _inserted(costs: Costs) -> Cell:
    one = (costs.insert, "I")
    return tuple(one if s in ("UU", "AA") else None for s in SYMBOLS)


def closed(cell: Cell, costs: Costs) -> Cell:
    """Insertion closure: turns put in before and behind, until nothing gets cheaper."""
    while True:
        more = _least(cell, _least(join(_inserted(costs), cell), join(cell, _inserted(costs))))
        if more == cell:
            return cell
        cell = more


@lru_cache(maxsize=256)
def leaf(symbol: str, costs: Costs) -> Cell:
    """The cell of one row: deleted, kept under its own role, or under another."""
    found = {"E": (costs.delete, "D")}
    if symbol not in DOOMED:
        extra = costs.truncated if symbol in TRUNCATED else 0
        found |= {"UU": (costs.rerole + extra, "R"), "AA": (costs.rerole + extra, "R")}
        own = {"s": "M", "u": "UU", "a": "AA"}.get(symbol.lower())
        if own:
            found[own] = min((extra, "K"), found.get(own, (extra, "K")))
    return closed(tuple(found.get(s) for s in SYMBOLS), costs)


def cells(line: str, costs: Costs) -> Cell:
    """The cell of a span of rows, combined bottom-up from spans of 1, 2, 4, ... rows.

    The symbols stand for every piece of a whole conversation, so any derivation of a span can be cut at any place, and each
    cut gives the same cell; one a span is enough.
    """
    return _short(line, costs) if len(line) <= 16 else _cut(line, costs)


def _cut(line: str, costs: Costs) -> Cell:
    if len(line) == 1:
        return leaf(line, costs)
    middle = 1 << ((len(line) - 1).bit_length() - 1)
    return join(cells(line[:middle], costs), cells(line[middle:], costs))


@lru_cache(maxsize=1 << 14)
def _short(line: str, costs: Costs) -> Cell:
    return _cut(line, costs)


class Edit(NamedTuple):
    """An edit in order: the row it is for (None for an insertion), its letter, and the role that is written (None if deleted)."""

    row: int | None
    letter: str
    role: str | None


def edits(audit: str, line: str, last: str) -> list[Edit]:
    """What an audit does to rows; ``last`` is the initial of the role written before ('' at the start)."""
    out, row = [], 0
    for letter in audit:
        role = None
        if letter != "D":
            initial = line[row].lower() if letter == "K" else "a" if last == "u" else "u"
            # A kept row keeps its own role, whatever stands behind the initial.
            role = "" if letter == "K" else USER if initial == "u" else ASSISTANT
            last = initial
        out.append(Edit(None if letter == "I" else row, letter, role))
        row += letter != "I"
    return out


# ------------------------------------------------------------------------------------------------ segments

def _segments(costs: Costs):
    """Rows come ordered by conversation: runs of them with their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, held = TaskContext.get().partitionId() << 33, None, []
        rows: list[tuple] = []

        def close() -> None:
            nonlocal number
            line = "".join(h[1] for h in held)
            cell = cells(line, costs)
            rows.append((key, number, line, [h[0] for h in held], [len(h[1]) for h in held], illegal_pairs(line),
                         [c[0] if c else None for c in cell], [c[1] if c else None for c in cell]))
            number += 1
            held.clear()

        def flat() -> pa.RecordBatch:
            batch = pa.record_batch({n: pa.array(c, t) for (n, t), c in zip(_SEGMENT_ARROW.items(), zip(*rows))})
            rows.clear()
            return batch

        size = 0
        for batch in batches:
            for conv, uid, line in zip(*(column(batch, n).to_pylist() for n in ("conv", "uid", "line"))):
                if held and (conv != key or size >= SEGMENT):
                    close()
                    size = 0
                key = conv
                held.append((uid, line))
                size += len(line)
            if len(rows) >= 512:
                yield flat()
        if held:
            close()
        if rows:
            yield flat()

    return run


_SEGMENT_ARROW = {"conv": pa.int64(), "segment": pa.int64(), "line": pa.string(), "uids": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()),
                  "illegal": pa.int64(), "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
_SEGMENT_ROW = ("conv bigint, segment bigint, line string, uids array<bigint>, counts array<bigint>, illegal bigint, "
                "costs array<bigint>, audits array<string>")


def illegal_pairs(line: str) -> int:
    """Neighbours whose initials are not su, ua or au."""
    plain = line.lower().translate(str.maketrans(DOOMED, INITIALS))
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One conversation's segments in order: its cheapest audit, cut into the segments' shares of it."""
    for batch in batches:
        rows = []
        for conv, parts in zip(column(batch, "conv").to_pylist(), column(batch, "parts").to_pylist()):
            level = [tuple((c, a) if c is not None else None for c, a in zip(p["costs"], p["audits"])) for p in parts]
            while len(level) > 1:
                level = [join(*level[k:k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
            cost, audit = min(level[0][k] for k in WHOLE if level[0][k])
            illegal = sum(p["illegal"] for p in parts) + sum(
                illegal_pairs(a["tail"] + b["head"]) for a, b in zip(parts, parts[1:]))
            at, last, written, shares = 0, "", 0, []
            for k, p in enumerate(parts):
                low, left = at, p["n"]
                while left:
                    left -= audit[at] != "I"
                    at += 1
                share = audit[low:] if k + 1 == len(parts) else audit[low:at]
                shares.append((p["segment"], share, last, written))
                put = len(share) - share.count("D")
                # Roles alternate, and only the very first can be a system turn.
                system = not written and put > 0 and _first_is_system(share, p["line"])
                if put:
                    last = ("s" if put == 1 else "ua"[(put - 2) % 2]) if system else "ua"[(put - 1 + (last == "u")) % 2]
                written += put
            rows.append((conv, cost, audit, illegal, shares))
        shares = pa.list_(pa.struct({"segment": pa.int64(), "share": pa.string(), "last": pa.string(), "written": pa.int64()}))
        for low in range(0, len(rows), 64):
            flat = [(*r[:4], [dict(zip(("segment", "share", "last", "written"), s)) for s in r[4]]) for r in rows[low:low + 64]]
            yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(
                ("conv", "cost", "audit", "illegal", "shares"), zip(*flat), (pa.int64(), pa.int64(), pa.string(), pa.int64(), shares))})


def _first_is_system(share: str, line: str) -> bool:
    row = 0
    for letter in share:
        if letter != "D":
            return letter == "K" and line[row].lower() == "s"
        row += 1
    return False


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that are written, each at its place: kept and reroled rows by uid, insertions beside a row's."""
    for batch in batches:
        names = ("line", "uids", "counts", "share", "last", "written")
        uid, role, letter, position = [], [], [], []
        for line, uids, counts, share, last, written in zip(*(column(batch, n).to_pylist() for n in names)):
            owner = np.repeat(np.arange(len(uids)), counts)
            row = 0
            for edit in edits(share, line, last):
                row = row if edit.row is None else edit.row
                if edit.role is not None:
                    uid.append(uids[owner[row]])
                    role.append(edit.role)
                    letter.append(edit.letter)
                    position.append(written)
                    written += 1
        yield pa.record_batch({"uid": pa.array(uid, pa.int64()), "new_role": pa.array(role, pa.string()),
                               "edit": pa.array(letter, pa.string()), "position": pa.array(position, pa.int64())})


# ------------------------------------------------------------------------------------------------ the operator

def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))


def _turns_first(name: str = "turn") -> Column:
    """Turns compare by this with nulls first."""
    return F.struct(F.col(name).isNotNull().alias("known"), F.col(name).alias("turn"))


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    own = turns.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), (~F.rlike("text", F.lit(_INK))).alias("blank"),
                      (~F.rlike("text", F.lit(_ENDS))).alias("open"), F.monotonically_increasing_id().alias("uid"))


def _marked(facts: DataFrame) -> DataFrame:
    """Add ``again`` (role and text were said at an earlier turn). A text said at very many turns is met in slices."""
    said = facts.filter(~F.col("blank")).groupBy("conv", "role", "digest").agg(
        F.min(_turns_first()).alias("first"), F.count("*").alias("n")).filter("n > 1")
    sliced = said.select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = facts.withColumn("salt", F.pmod(F.col("uid"), F.lit(SALTS)).cast("int"))
    met = salted.join(sliced, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                      & (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt")), "left")
    return met.withColumn("again", F.coalesce(F.col("first") < _turns_first(), F.lit(False)) & ~F.col("blank")).select(
        *facts.columns, "again")


@dataclass(frozen=True)
class Repair:
    """``report``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one row a conversation.
    ``turns``: (conv, position, role, text, edit), the repaired turns in order of conversation and position."""

    report: DataFrame
    turns: DataFrame


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", costs: Costs = Costs()) -> Repair:
    """Find the cheapest edits after which each conversation's roles begin with the initials of s?(ua)+, or nothing is left.

    Rows of a conversation go by turn, nulls first, then role, then the SHA-256 of the text. A row's first fault counts: blank,
    duplicate (role and text came before), truncated (no full stop, exclamation or question mark at the end). Blank and
    duplicate rows must be deleted; a truncated row that stays costs extra. Edits are Keep, Rerole (to user or assistant), Delete
    and Insert (an empty user or assistant turn). Of equally cheap ones the ASCII-least audit is taken. ``illegal`` counts
    neighbours whose initials aren't su, ua or au; ``gaps`` is how many turn numbers are missing between the least and the
    largest (null where that is no 64-bit number).

    How: rows without their texts are folded (copies become one row with a count) and sorted by ranges, so a long
    conversation may lie in many partitions. Each stretch of at most some 4,096 rows is parsed where it lies, bottom-up from
    single rows closed under insertion; a conversation's stretches are combined in pairs. What is collected for one
    conversation is eight audits of its length. Texts move once, when they meet their edits.

    Null role and text are empty. Rows with null conversation are one conversation. Rows that are equal in all are duplicates
    of the first. Other columns are ignored. An empty table gives two empty tables.
    """
    width, order = shuffle_width(turns.sparkSession), ("conv", "turn", "role", "digest")
    rows = staged(_rows(turns, conv_col, turn_col, role_col, text_col), "repair-rows")
    facts = staged(rows.groupBy(*order, "blank", "open").agg(F.count("*").alias("n"), F.min("uid").alias("uid")), "repair-facts")
    marked = staged(_marked(facts), "repair-marked")
    initial, gone = _initial(F.col("role")), F.col("blank") | F.col("again")
    doomed = F.translate(initial, INITIALS, DOOMED)
    first = F.when(gone, doomed).when(F.col("open"), F.translate(initial, INITIALS, TRUNCATED)).otherwise(initial)
    lined = marked.select(*order, "uid", F.concat(first, F.repeat(doomed, (F.col("n") - 1).cast("int"))).alias("line"))
    segments = staged(lined.repartitionByRange(width, *order).sortWithinPartitions(*order).select("conv", "uid", "line").mapInArrow(
        _segments(costs), _SEGMENT_ROW), "repair-segments")
    part = F.struct("segment", F.length("line").cast("bigint").alias("n"), F.substring("line", 1, 1).alias("head"),
                    F.substring("line", -1, 1).alias("tail"), "line", "illegal", "costs", "audits")
    folded = staged(segments.groupBy("conv").agg(F.sort_array(F.collect_list(part)).alias("parts")).mapInArrow(_folded, (
        "conv bigint, cost bigint, audit string, illegal bigint, "
        "shares array<struct<segment: bigint, share: string, last: string, written: bigint>>")), "repair-folded")

    fresh = F.when(F.col("again"), F.lit(0)).otherwise(F.lit(1))
    faults = marked.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - fresh)).alias("duplicate"),
        F.sum(F.when(~gone & F.col("open"), 1).otherwise(0)).alias("truncated"))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("most", "least")]
    totals = faults.groupBy("conv").agg(
        F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("turn").alias("distinct"),
        *(F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated")))
    gaps = F.when(F.col("most").isNull(), 0).otherwise((wide[0] - wide[1] + 1 - F.col("distinct")).try_cast("bigint"))
    report = totals.withColumn("gaps", gaps).join(folded.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv"))).select(
        F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    shares = folded.select(F.inline("shares")).withColumnRenamed("segment", "_segment")
    decided = segments.join(shares, F.col("segment") == F.col("_segment")).select(
        "line", "uids", "counts", "share", "last", "written").mapInArrow(
        _decided, "uid bigint, new_role string, edit string, position bigint")
    keyed = decided.join(facts.select(F.col("uid").alias("_uid"), *order), F.col("uid") == F.col("_uid")).drop("_uid")
    texts = rows.select("uid", *order, "text")
    # An edit and its text have equal keys, so they come side by side into one partition.
    met = (keyed.withColumn("is_text", F.lit(False)).unionByName(texts.withColumn("is_text", F.lit(True)), allowMissingColumns=True)
           .repartitionByRange(width, *order, "uid").sortWithinPartitions(*order, "uid", "is_text", "position"))
    written = met.select("conv", "uid", "role", "is_text", "new_role", "edit", "position", "text").mapInArrow(
        _written, "conv bigint, position bigint, role string, text string, edit string")
    return Repair(report, written.withColumnRenamed("conv", conv_col))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits come before the text of their row: give the turns that stay their texts, and insertions their place."""
    open_edits: list[tuple] = []
    for batch in batches:
        names = ("conv", "uid", "role", "is_text", "new_role", "edit", "position")
        texts, out = column(batch, "text"), []
        for k, (conv, uid, role, is_text, new_role, edit, position) in enumerate(zip(*(column(batch, n).to_pylist() for n in names))):
            if not is_text:
                open_edits.append((uid, position, new_role, edit))
            elif open_edits and open_edits[0][0] == uid:
                for _, at, new, letter in open_edits:
                    out.append((conv, at, new or role, "" if letter == "I" else texts[k].as_py(), letter))
                open_edits = []
        if out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(("conv", "position", "role", "text", "edit"), zip(*out), kinds)})


# ------------------------------------------------------------------------------------------------ digests

def _packed(conv_col: str):
    """Turns that follow each other in a conversation, joined where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most_bytes=_PART):
                rows: list[list] = []
                for conv, position, role, text in zip(*(column(part, n).to_pylist() for n in (conv_col, "position", "role")),
                                                      text_column(part).to_pylist()):
                    if not rows or rows[-1][0] != conv or position != rows[-1][1] + len(rows[-1][2]):
                        rows.append([conv, position, []])
                    rows[-1][2].append(f"{role}:{text}")
                flat = [(c, p, "\n".join(said)) for c, p, said in rows]
                yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(
                    ("conv", "position", "said"), zip(*flat) if flat else ((), (), ()), (pa.int64(), pa.int64(), pa.string()))})

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        done = []
        for conv, said in zip(column(batch, "conv").to_pylist(), column(batch, "said").to_pylist()):
            if digest is None or conv != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = conv, hashlib.sha256(said.encode())
            else:
                digest.update(b"\n" + said.encode())
        if done:
            yield pa.record_batch({"conv": pa.array([d[0] for d in done], pa.int64()), "sha": pa.array([d[1] for d in done])})
    if digest is not None:
        yield pa.record_batch({"conv": pa.array([key], pa.int64()), "sha": pa.array([digest.hexdigest()])})


def turn_digests(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, sha): SHA-256 of each conversation's ``role:text`` lines in order of position.

    A digest needs its text in order, so the parts of a conversation meet in one task, which streams them.
    """
    parts = turns.mapInArrow(_packed(conv_col), "conv bigint, position bigint, said string")
    dealt = parts.repartition(shuffle_width(turns.sparkSession), "conv").sortWithinPartitions("conv", "position")
    return dealt.mapInArrow(_digested, "conv bigint, sha string").withColumnRenamed("conv", conv_col)


def damage_turns(turns: DataFrame) -> DataFrame:
    """``conversations`` rows with faults by crc32(``conv_id:turn``) modulo 20; nulls become one space.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    fault = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(20))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    changed = turns.select(
        "conv_id", "turn", F.when(fault == 4, F.lit(USER)).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


def repair_digests(turns: DataFrame, repair: Repair) -> DataFrame:
    """The report for every conversation of ``turns``, those without rows to repair too, with the digest of the repaired text."""
    convs = turns.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    digests = turn_digests(repair.turns).select(F.col("conv_id").alias("_of"), "sha")
    report = repair.report.withColumnRenamed("conv_id", "_conv")
    met = convs.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    zero = F.lit(0).cast("bigint")
    # A gap count can be null by itself; only conversations without rows get zeros.
    counts = [F.when(F.col("audit").isNull(), zero).otherwise(F.col(c)).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
