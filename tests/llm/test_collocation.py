"""Collocations against brute force, and the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents
from tidemark.llm import collocation
from tidemark.llm.collocation import Summary, cut_score, mine_collocations, pack_sorted, unpack_sorted

SCHEMA = "doc_id bigint, text string, lang string"


def brute(rows, least=10, most_words=3, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, most_words + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        found = []
        for p, a in many.items():
            inside = any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= 50 * a for q, b in many.items()) \
                if len(p) < most_words else False
            if not inside:
                score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def rows_of(n, seed):
    rng = random.Random(seed)
    words = "New York the The of and é 漢 x\x00y \xa0 \x1c big\ttab".split(" ") + ["w%d" % i for i in range(40)]
    weights = [12, 12, 30, 10, 20, 15, 5, 5, 4, 4, 4, 4] + [1] * 40
    out = []
    for i in range(n):
        text = "".join(rng.choices(words, weights)[0] + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", ": "]) for _ in range(rng.randrange(60)))
        out.append((rng.choice([i, None, 3]), rng.choice([text, text, text, text, None, ""]), rng.choice(["en", "en", "en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("least,most_words,top", [(10, 3, 2000), (3, 4, 7), (2, 2, 50)])
def test_collocations_match_brute_force(spark, least, most_words, top):
    rows = rows_of(400, least) + [(d, t, "en") for d, t in documents()] + [(i, "same words here, " * 30, "en") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("phrase", "n", "words", "a", "slice", "bucket")})
    got = mine_collocations(df.repartition(7), least, most_words, top).collect()
    assert [tuple(r) for r in sorted(got)] == brute(rows, least, most_words, top)


def test_a_tiny_filter_changes_nothing(spark):
    rows = rows_of(200, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    whole, tiny = (sorted(collocation.count_phrases(df, 5, most_bits=bits).collect()) for bits in (1 << 27, 1 << 10))
    assert whole == tiny and len(whole) > 20


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mine_collocations(empty).count() == 0
    assert mine_collocations(spark.createDataFrame([(1, None, "en"), (2, " ., ", None)], SCHEMA)).count() == 0


@pytest.mark.parametrize("merged", [False, True])
def test_every_frequent_key_survives(merged):
    rng, least = np.random.default_rng(3), 10
    for trial in range(20):
        keys = (rng.zipf(1.3, 30_000) % 50_000).astype(np.uint32) if trial % 2 else rng.integers(0, 4000, 30_000, dtype=np.uint32)
        parts = [Summary(len(keys) // least + 1) for _ in range(4 if merged else 1)]
        for k, low in enumerate(range(0, len(keys), 500)):
            own, counts = np.unique(keys[low:low + 500], return_counts=True)
            parts[k % len(parts)].add(own, counts)
            if k % 7 == 0:
                parts[k % len(parts)].fold()
        whole = parts[0]
        for other in parts[1:]:
            whole.merge(other)
        left = set(whole.possible(least).tolist())
        values, counts = np.unique(keys, return_counts=True)
        assert set(values[counts >= least].tolist()) <= left and len(whole.keys) <= whole.capacity
        assert whole.missed <= len(keys) / (whole.capacity + 1)


def test_sorted_numbers_pack():
    for n in (0, 1, 1000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64)).astype(np.uint32)
        assert (unpack_sorted(pack_sorted(keys)) == keys).all()


def test_scores_are_exact(spark):
    rng = random.Random(1)
    rows = [(a, rng.randrange(a, 10**15), rng.randrange(a, 10**15)) for a in (rng.randrange(1, 10**14) for _ in range(300))]
    rows += [(10**15, 10**15, 10**15), (1, 1, 1), (3, 10**15, 10**15)]
    got = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select("*", cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in got)
