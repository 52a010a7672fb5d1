"""Syncmer fingerprints against a plain loop."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, documents, frame, prose
from tidemark.llm import queries, syncmers


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(data, seed):
    """xxhash64 of a binary and then of an int, as Spark's function of two columns gives it."""
    first = xxhash.xxh64_intdigest(data, seed=42)
    return signed(xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), seed=first))


def brute_anchors(text, k=syncmers.K, s=syncmers.S):
    data = text.encode()
    inner = [chained(data[i:i + s], 11) for i in range(len(data) - s + 1)]
    out = []
    for i in range(len(data) - k + 1):
        own = inner[i:i + k - s + 1]
        if min(own) in (own[0], own[-1]):
            out.append((i, chained(data[i:i + k], 29)))
    return out or ([(0, chained(data, 29))] if data else [])


def brute_likeness(a, b):
    a, b = Counter(h for _, h in a), Counter(h for _, h in b)
    return 2 * (a & b).total() / (a.total() + b.total()) if a or b else 1.0


def brute(rows, k=syncmers.K, s=syncmers.S):
    def order(row):
        return row[0] is not None, row[0] or 0, signed(xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42))
    rows = sorted(((d, t or "") for d, t in rows), key=order)
    marks = [brute_anchors(t, k, s) for _, t in rows]
    out = []
    for i, (d, t) in enumerate(rows):
        j = (i + 1) % len(rows)
        q = len(t) // 4
        edited = t[:len(t) - q] + rows[j][1][:q]
        other = brute_anchors(edited, k, s)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *("".join(f"{h & 0x7FFFFFFF | 0x80000000:08x}" for _, h in m) for m in (marks[i], other)),
                    brute_likeness(marks[i], other), brute_likeness(marks[i], marks[j])))
    return sorted(out, key=repr)


def made(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_chars", F.sha2("edited", 256), "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


@pytest.mark.parametrize("stretch", [syncmers.STRETCH, 50])
def test_fingerprints_match_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(syncmers, "STRETCH", stretch)
    rows = documents() + [(None, prose(2, 60)), (None, None), (3, prose(1, 40)), (3, prose(1, 40)), (-5, prose(5, 9000)), (99, "x" * 24), (98, "y" * 23)]
    df = frame(spark, rows, clashing=True).withColumns({c: F.lit("x") for c in ("at", "guest", "range", "next_text", "kept", "head", "edited")})
    assert made(syncmers.fingerprint_neighbours(df.repartition(6))) == brute(rows)


def test_other_lengths_and_few_rows(spark):
    for rows in ([(1, prose(3, 50))], [(1, "a"), (2, "")], [(7, None)]):
        assert made(syncmers.fingerprint_neighbours(frame(spark, rows), k=9, s=4)) == brute(rows, 9, 4)
    assert syncmers.fingerprint_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op13_fingerprints(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == brute(rows)
    equal = {}
    for d, t in rows:
        fingerprint = next(r[3] for r in got if r[0] == d)
        assert equal.setdefault(t, fingerprint) == fingerprint
    long = [r for r in got if r[1] > 400]
    assert min(r[5] for r in long) > 0.6 and sorted(r[6] for r in long)[len(long) // 2] < 0.1


def test_anchors_move_with_their_passage(spark):
    passage = prose(6, 80)
    df = spark.createDataFrame([(1, passage, "before " * 3 + passage + " after")], "pair int, a string, b string")
    marked = df.select("pair", syncmers.anchors(F.col("a")).alias("x"), syncmers.anchors(F.col("b")).alias("y"))
    found = syncmers.matched(marked, "x", "y", ("pair",)).collect()
    assert len(found) == len({h for _, h in brute_anchors(passage)}) and {r.at_b - r.at_a for r in found} == {21}


def test_no_python_runs_over_rows(spark):
    plan = syncmers.fingerprint_neighbours(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") <= 2
