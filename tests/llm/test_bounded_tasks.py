"""Tasks of the pipeline read a large batch in parts, so that what they hold of it stays small."""

import subprocess
import sys

import numpy as np
import pyarrow as pa

from tidemark.llm import decontaminate, toxicity
from tidemark.llm.chunks import Memory


def test_shingles_are_counted_in_small_parts():
    texts = ["a b c d e f " * 1000] * 500  # 6 MB
    sieve = np.ones(1 << decontaminate.SIEVE_BITS, bool)
    out = list(decontaminate._counts([5], sieve)(iter([pa.record_batch({"text": texts})])))
    assert len(out) >= 6 and sum(sum(b.column(2).to_pylist()) for b in out) == 500 * 5996


def test_words_are_counted_in_parts():
    texts = ["one two " * 1000] * 1500  # 12 MB
    batch = pa.record_batch({"text": texts, "label": pa.array([i % 2 for i in range(1500)], pa.int32())})
    out = [r for b in toxicity._word_counts(iter([batch])) for r in b.to_pylist()]
    assert len({id(b) for b in list(toxicity._word_counts(iter([batch])))}) >= 4
    assert sum(r["n"] for r in out if r["word"] == b"one" and r["label"] == 1) == 750


def test_tidy_gives_large_blocks_back_while_the_task_runs():
    """In a process of its own: after one large block the C library would keep up to 64 MB of free memory."""
    program = """
import re
from tidemark.llm.staging import tidy

def own_mb():
    with open("/proc/self/smaps_rollup") as told:
        return int(re.search(r"Anonymous:\\s+(\\d+)", told.read())[1]) / 1024

def run(batches):
    before = own_mb()
    block = bytearray(31 << 20); del block
    blocks = [bytearray(b"x") * (2 << 20) for _ in range(25)]; del blocks
    yield own_mb() - before

print(max(tidy(run)(iter([]))))
"""
    told = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True, timeout=60)
    assert float(told.stdout) < 15


def test_memory_does_not_walk_through_itself_to_learn():
    class Watched(Memory):
        def keys(self):
            raise AssertionError("all known stretches were looked at")

    known = Watched(lambda new: [x.encode() for x in new], most=4)
    known.learn([["a", "b"], ["b", "c"]])
    known.learn([["c", "d"]])
    assert dict(known) == {x: x.encode() for x in "abcd"}
    known.learn([["d", "e"]])  # over its bound: starts again with what is asked for
    assert dict(known) == {"d": b"d", "e": b"e"}


def test_the_sieve_stays_packed(spark):
    rng = np.random.default_rng(4)
    wanted = np.unique(rng.integers(0, 1 << 64, 1000, np.uint64))
    sieve = decontaminate._sieve(spark.createDataFrame([(int(h),) for h in wanted.view(np.int64)], "h bigint"))
    assert sieve.nbytes == 1 << (decontaminate.SIEVE_BITS - 3)
    assert decontaminate._seen(sieve, wanted).all()
    asked, shift = rng.integers(0, 1 << 64, 200_000, np.uint64), np.uint64(64 - decontaminate.SIEVE_BITS)
    assert (decontaminate._seen(sieve, asked) == np.isin(asked >> shift, wanted >> shift)).all()
