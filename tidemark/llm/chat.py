"""Chat formatting checked by a grammar round trip, with a loss mask over assistant texts.

A turn is ``### role: text``, a line break, ``</turn>`` and a line break. Inside a text each control
string that would be read as structure gets a backslash in front.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import column, pieces, shuffle_width, text_column

#: Fixed values of the template.
OPEN, CLOSE, TRAINED = "### ", "\n</turn>\n", "assistant"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_HEADER = re.compile(r"### ([A-Za-z0-9_.~%-]*): ")
#: Digest text of one conversation handed on in parts of this size.
_PART = 1 << 20


def escape(text: str) -> str:
    """A backslash before each control string, whatever backslashes stand there already."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def render(role: str, text: str) -> str:
    return f"{OPEN}{quote(role, safe='')}: {text}{CLOSE}"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """The turns of a formatted text: (role, text, and where the escaped text begins and ends).

    Control strings without a backslash are structure. Raises ValueError where the grammar doesn't hold.
    """
    turns, at = [], 0
    marks = [m for m in _CONTROL.finditer(formatted) if not m[1]]
    if len(marks) % 2:
        raise ValueError("a turn is not closed")
    for opening, closing in zip(marks[::2], marks[1::2]):
        header = _HEADER.match(formatted, opening.start())
        end = closing.start() - 1
        if opening.start() != at or not header or closing[2] != "</turn>" or header.end() > end \
                or formatted[end] != "\n" or formatted[closing.end():closing.end() + 1] != "\n":
            raise ValueError(f"no turn at {at}")
        turns.append((unquote(header[1]), unescape(formatted[header.end():end]), header.end(), end))
        at = closing.end() + 1
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return turns


def format_turn(role: str, text: str) -> str:
    """Render a turn; while it doesn't read back as itself, escape what conflicts."""
    inner = text
    for change in (lambda t: t, escape):
        inner = change(inner)
        formatted = render(role, inner)
        try:
            if [(r, t) for r, t, *_ in parse(formatted)] == [(role, text)]:
                return formatted
        except ValueError:
            pass
    raise ValueError("a turn does not read back as itself")


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            roles = text_column(part, "role").to_pylist()
            out = [format_turn(r, t) for r, t in zip(roles, text_column(part).to_pylist())]
            spans = [parse(f)[0][2:] if r == TRAINED else (None, None) for r, f in zip(roles, out)]
            yield pa.record_batch({
                "conv": column(part, "conv"), "turn": column(part, "turn"), "role": column(part, "role"), "tie": column(part, "tie"),
                "formatted": pa.array(out, pa.string()), "loss_start": pa.array([s[0] for s in spans], pa.int64()),
                "loss_end": pa.array([s[1] for s in spans], pa.int64())})


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv, turn, role, tie, formatted, loss_start, loss_end): each turn rendered, in order of conversation and turn.

    A conversation's formatted text is its turns' ``formatted`` one after another. ``loss_start`` and
    ``loss_end`` bound the assistant's escaped text in it, and are null elsewhere. Each turn is parsed
    again and compared with its source before it is written.

    Turns are dealt by ranges of (conversation, turn, role, hash of the text), so one conversation may lie in many
    partitions. Null text is empty, null role reads as empty; rows with null conversation are one conversation, and a
    null turn comes first. Rows with equal turn are ordered by role, then by the text's hash. Other columns are ignored.
    """
    own = turns.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.col(text_col).cast("string").alias("text"))
    keyed = own.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    order = ("conv", "turn", "role", "tie")
    return keyed.repartitionByRange(shuffle_width(turns.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(_formatted, (
        "conv bigint, turn bigint, role string, tie bigint, formatted string, loss_start bigint, loss_end bigint"))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of turns of one conversation, parsed from the output: what to digest, and counts."""
    for batch in batches:
        for part in pieces(batch, "formatted", _PART):
            conv = column(part, "conv").to_pylist()
            rows: list[tuple] = []
            for key, turn, role, tie, formatted, low, high in zip(conv, *(column(part, n).to_pylist() for n in (
                    "turn", "role", "tie", "formatted", "loss_start", "loss_end"))):
                (read_role, text, *_), = parse(formatted)
                loss = unescape(formatted[low:high]) if low is not None else ""
                if not rows or rows[-1][0] != key:
                    rows.append((key, turn, role, tie, [], [], [0, 0, 0]))
                said, trained, counts = rows[-1][4:]
                said.append(f"{read_role}\n{text}\n")
                trained.append(loss)
                for k, n in enumerate((1, len(loss), len(formatted))):
                    counts[k] += n
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            flat = [(*r[:4], "".join(r[4]), "".join(r[5]), *r[6]) for r in rows]
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(
                ("conv", "turn", "role", "tie", "said", "trained", "n", "loss", "chars"), zip(*flat), kinds)})


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts come in order; digests are fed as parts stream by."""
    key, said, trained, counts, done = None, None, None, np.zeros(3, np.int64), []

    def close() -> None:
        if said is not None:
            done.append((key, int(counts[0]), said.hexdigest(), int(counts[1]), trained.hexdigest(), int(counts[2])))

    def rows() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ("conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*done), kinds)})

    for batch in batches:
        for conv, a, b, n, loss, chars in zip(*(column(batch, c).to_pylist() for c in ("conv", "said", "trained", "n", "loss", "chars"))):
            if said is None or conv != key:
                close()
                key, said, trained, counts = conv, hashlib.sha256(), hashlib.sha256(), np.zeros(3, np.int64)
            said.update(a.encode())
            trained.update(b.encode())
            counts += (n, loss, chars)
        if done:
            yield rows()
            done.clear()
    close()
    if done:
        yield rows()


def conversation_digests(output: DataFrame, conv_name: str = "conv_id") -> DataFrame:
    """Per conversation: turns, and digests of what the written output parses to.

    Consecutive turns are packed where they are read. A digest needs its text in order, so a conversation's parts
    meet in one task, which streams them and holds one part at a time.
    """
    parts = output.mapInArrow(_read_back, (
        "conv bigint, turn bigint, role string, tie bigint, said string, trained string, n bigint, loss bigint, chars bigint"))
    order = ("conv", "turn", "role", "tie")
    dealt = parts.repartition(shuffle_width(output.sparkSession), "conv").sortWithinPartitions(*order)
    return dealt.mapInArrow(_digested, (
        "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )).withColumnRenamed("conv", conv_name)
