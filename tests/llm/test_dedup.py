"""Substring, exact and SimHash dedup, and decontamination, against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.data import SCHEMA, documents, frame, prose
from tidemark.llm import decontaminate, exact, graph, simhash, substring
from tidemark.llm.words import word_hashes


def brute_substring(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i:i + window])
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in words:
        gone = {i + k for i in range(len(w) - window + 1) if d is not None and least[tuple(w[i:i + window])] < d for k in range(window)}
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [1, 3, 13])
def test_substring_matches_brute_force(spark, window):
    rows = documents() + [(None, prose(2, 60)), (3, prose(1, 40)), (3, prose(7, 20))]
    got = substring.remove_repeated_windows(frame(spark, rows, clashing=True), window=window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == brute_substring(rows, window)
    for r in got:
        assert r.n_removed == sum(b - a for a, b in zip(r.span_starts, r.span_ends))
        assert all(b < a for b, a in zip(r.span_ends, r.span_starts[1:]))


def test_words_longer_than_a_stretch_hash_whole():
    data = np.frombuffer(b"a" * 3_000_000 + b" " + b"a" * 2_999_999 + b"b", np.uint8)
    h = word_hashes(data, np.array([0, 3_000_001]), np.array([3_000_000, 6_000_001]))
    again = word_hashes(data[3_000_001:], np.array([0]), np.array([3_000_000]))
    assert h[0] != h[1] and h[1] == again[0]


def test_long_words_that_collide_modulo_two_to_the_64_stay_apart(spark):
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    words = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    tail = " ".join(prose(5, 12).split())
    rows = [(1, f"{words[0]} {tail}"), (2, f"{words[1]} {tail}"), (3, f"{words[1]} {tail}")]
    got = substring.remove_repeated_windows(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substring(rows, 13)


@pytest.mark.parametrize("cells", [exact.MAX_CELLS, 2])
def test_exact_matches_brute_force_with_any_filter(spark, cells):
    rows = documents() + [(None, "one"), (40, "o n e"), (5, "")]
    got = exact.exact_duplicates(frame(spark, rows, clashing=True), carry=("text", "kept", "row"), max_cells=cells).collect()
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((d, t or ""))
    want = []
    for key, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        want += [(d, best[0], len(own), hashlib.sha256(key.encode()).hexdigest()) for d, _ in own]
    assert sorted(((r[0], r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(want, key=repr)
    kept = [r for r in got if r[3] is True]
    assert len(kept) == len(groups) and {r.row for r in got} == {"6"}


def brute_components(prints, most):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_simhash_matches_brute_force(spark, bucket):
    rows = documents()
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, rows, clashing=True), bucket=bucket).collect()}
    prints = {d: brute_print(t) for d, t in rows}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == prints
    assert {d: r.component_id for d, r in got.items()} == brute_components(prints, 2)


@pytest.mark.parametrize("most,bucket", [(2, 4096), (2, 20), (1, 4096), (0, 4096)])
def test_links_of_a_dense_cluster_and_a_chain(spark, most, bucket):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    prints = {i: base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for i in range(300)}
    chain = int(rng.integers(0, 2**63))
    for k in range(64):
        chain ^= 1 << k
        prints[300 + k] = chain
    distinct = {p: i for i, p in sorted(prints.items(), reverse=True)}
    signed = lambda p: p - 2**64 if p >= 2**63 else p
    df = spark.createDataFrame([(signed(p), i) for p, i in distinct.items()], "print bigint, least bigint")
    roots = {r.node: r.root for r in graph.components(simhash.near_links(df, most, bucket), "a", "b").collect()}
    want = brute_components({i: p for p, i in distinct.items()}, most)
    groups = lambda names: sorted(sorted(g) for g in names.values())
    ours, theirs = defaultdict(list), defaultdict(list)
    for p, i in distinct.items():
        ours[roots.get(signed(p), signed(p))].append(i)
        theirs[want[i]].append(i)
    assert groups(ours) == groups(theirs)


def test_thresholds_cover_every_pair():
    rng = np.random.default_rng(1)
    bits = rng.random((500, 64)) < rng.random(64)
    both = bits.T.astype(float) @ bits
    for total in (500, 10**7, 10**11):
        plan = simhash.plan_parts(total, both * (total / 500), 2)
        used = [b for group, _ in plan for b in group]
        assert len(used) == len(set(used))
        for _ in range(200):
            flipped = set(rng.choice(64, 2, replace=False).tolist())
            assert any(len(flipped & set(group)) <= t for group, t in plan)


ITEMS = [(1, prose(1, 40)), (2, prose(1, 40)), (3, "Alpha; BETA gamma"), (4, None), (5, "..."), (None, "zeta eta theta iota"), (6, prose(9, 11))]


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.mark.parametrize("broadcast", [32 << 20, 0])
def test_decontamination_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", broadcast)
    rows = documents() + [(None, prose(1, 40)), (3, "alpha beta GAMMA!"), (3, "nothing of it")]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.digests(decontaminate.benchmark_hits(frame(spark, rows, clashing=True), items)).collect()
    windows = defaultdict(set)
    for item, text in ITEMS:
        w = words_of(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    want = []
    for d, text in rows:
        w, hit, found = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= own - {None}
        names = ",".join(sorted(map(str, found)))
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert substring.remove_repeated_windows(none).count() == 0
    assert exact.exact_duplicates(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert decontaminate.benchmark_hits(none, items).count() == 0
    assert {r.n_hit for r in decontaminate.benchmark_hits(frame(spark), items).collect()} == {0}
