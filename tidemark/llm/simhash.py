"""SimHash near-dedup: generalised pigeonhole candidates, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.staging import column, id_and_text, pieces, shuffle_width, staged, text_column, tidy

BITS, SEED = 64, 42
SHINGLE_WORDS, MOST_DIFFERENT = 3, 2
#: Fingerprints compared with one another inside a bucket; larger buckets take the exact way of ``_variants``.
BUCKET = 4096
#: The cost of shuffling one probe, in compared pairs.
PROBE_COST = 200.0


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, joined by one space; of all words if there are fewer."""
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - width + 1)
    last = ends[len(words) - count:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(text[a:b], SEED) for a, b in zip(starts[:count].tolist(), last.tolist())], np.uint64)


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """Bit k is set if it is set in over half of the shingles' hashes; zero for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = shingle_hashes(words, width)
    counts = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low:low + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                prints = np.array([fingerprint(t, width) for t in text_column(part).to_pylist()], np.uint64)
                yield pa.record_batch({"id": column(part, "id"), "print": pa.array(prints.view(np.int64))})

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id, print): 64-bit SimHash fingerprints as signed numbers. Null text is empty."""
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(_fingerprints(width)), "id bigint, print bigint")


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = np.zeros((BITS, BITS))
    for batch in batches:
        values = column(batch, "print").to_numpy().view(np.uint64)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        both += bits.T @ bits
    yield pa.record_batch({"cell": pa.array(np.arange(BITS * BITS)), "n": pa.array(both.ravel().astype(np.int64))})


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set. Tasks send 4,096 sums each."""
    sums = prints.mapInArrow(_bit_sums, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for row in sums:
        both[row["cell"]] = row["n"]
    return prints.count(), both.reshape(BITS, BITS)


def group_bits(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the 64 bits into parts so that correlated bits share a part."""
    p = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs(both / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        group = [max(left, key=lambda b: (sum(tied[b, o] for o in left), -b))]
        left.remove(group[0])
        while len(group) < size:
            nearest = max(left, key=lambda b: (tied[b, group].max(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(group)
    return groups


def meeting_chances(total: int, both: np.ndarray, group: list[int]) -> list[float]:
    """Estimated chance that two fingerprints differ in at most 0, 1, 2 bits of a group.

    Bits agree along a tree in which each bit depends on the earlier bit it is most tied to.
    """
    n = max(total, 1)
    p = np.diag(both) / n

    def agree(a: int, b: int | None = None) -> float:
        if b is None:
            return float(p[a] ** 2 + (1 - p[a]) ** 2)
        cells = np.array([both[a, b], both[a, a] - both[a, b], both[b, b] - both[a, b], n - both[a, a] - both[b, b] + both[a, b]]) / n
        return float((cells ** 2).sum())

    chance, odds = agree(group[0]), [(1 - agree(group[0])) / agree(group[0])]
    for k, bit in enumerate(group[1:], 1):
        given = max(min(agree(bit, other) / agree(other), 1.0) for other in group[:k])
        given = max(given, 1e-9)
        chance *= given
        odds.append((1 - given) / given)
    one, two = sum(odds), sum(a * b for a, b in combinations(odds, 2))
    return [min(1.0, chance * x) for x in (1, 1 + one, 1 + one + two)]


def _probes(width: int, threshold: int) -> int:
    return sum(1 if t == 0 else width if t == 1 else width * (width - 1) // 2 for t in range(threshold + 1))


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 (part not used) up for each part, with the given sum and the least summed cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for threshold in range(-1, len(part)):
                now = (cost + (part[threshold] if threshold >= 0 else 0.0), [*chosen, threshold])
                if spent + threshold not in step or now < step[spent + threshold]:
                    step[spent + threshold] = now
        best = step
    return best[total]


def plan_parts(total: int, both: np.ndarray, most: int = MOST_DIFFERENT) -> list[tuple[list[int], int]]:
    """Parts of bits with their thresholds, the cheapest over 2, 3 and 4 parts.

    Generalised pigeonhole: with thresholds that sum to ``most`` - parts + 1, any two
    fingerprints with at most ``most`` differing bits are within the threshold of some part.
    """
    plans = []
    for parts in (2, 3, 4):
        groups = group_bits(total, both, parts)
        costs = []
        for group in groups:
            chances = meeting_chances(total, both, group)
            costs.append([PROBE_COST * total * _probes(len(group), t) + total * min(total * chances[t], float(BUCKET)) / 2
                          + max(0.0, total * chances[t] - BUCKET) * PROBE_COST * BITS for t in range(most + 1)])
        cost, thresholds = allocate(costs, most - parts + 1)
        plans.append((cost, parts, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(plans)[2]


def _keys(plan: list[tuple[list[int], int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = column(batch, "print").to_numpy().view(np.uint64)
            for part, (bits, threshold) in enumerate(plan):
                mask = np.uint64(sum(1 << b for b in bits))
                for flips in range(threshold + 1):
                    for chosen in combinations(bits, flips):
                        key = (prints & mask) ^ np.uint64(sum(1 << b for b in chosen))
                        yield pa.record_batch({"part": pa.array(np.full(len(prints), part, np.int32)),
                                               "key": pa.array(key.view(np.int64)), "print": pa.array(prints.view(np.int64)),
                                               "guest": pa.array(np.full(len(prints), flips > 0))})

    return run


def _joined(prints: np.ndarray, home: np.ndarray, most: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``most`` bits of each other: (print, smallest print it reaches here)."""
    order = np.argsort(prints)
    prints, home = prints[order], home[order]
    reach, changed = np.arange(len(prints)), True
    while changed:
        before = reach.copy()
        for low in range(0, len(prints), block):
            rows = slice(low, low + block)
            near = np.bitwise_count(prints[rows, None] ^ prints[None, :]) <= most
            near &= home[rows, None] | home[None, :]
            reach[rows] = np.minimum(reach[rows], np.where(near, reach[None, :], len(prints)).min(axis=1))
        reach = np.minimum(reach, reach[reach])
        changed = bool((before != reach).any())
    moved = np.flatnonzero(reach != np.arange(len(prints)))
    return prints[moved], prints[reach[moved]]


def _bucket_links(most: int, bucket: int):
    """Verified links of each (part, key) run; the members of a run beyond ``bucket`` come out as ``large``."""

    def links(prints: np.ndarray, guest: np.ndarray) -> pa.RecordBatch | None:
        if guest.all():
            return None
        a, b = _joined(prints, ~guest, most)
        return _links(a, b, False) if len(a) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held_p, held_g, large = None, [], [], False
        for batch in batches:
            part, key, prints = (column(batch, n).to_numpy() for n in ("part", "key", "print"))
            prints, guest = prints.view(np.uint64), column(batch, "guest").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *edge.tolist(), len(key)]
            for low, high in zip(bounds[:-1], bounds[1:]):
                if low == high:
                    continue
                if (own := (part[low], key[low])) != open_key:
                    if sum(map(len, held_p)) > 1 and (out := links(np.concatenate(held_p), np.concatenate(held_g))):
                        yield out
                    open_key, held_p, held_g, large = own, [], [], False
                held_p.append(prints[low:high])
                held_g.append(guest[low:high])
                if large or sum(map(len, held_p)) > bucket:
                    members = np.concatenate(held_p)
                    yield _links(members, members, True)
                    held_p, held_g, large = [], [], True
        if sum(map(len, held_p)) > 1 and (out := links(np.concatenate(held_p), np.concatenate(held_g))):
            yield out

    return run


def _links(a: np.ndarray, b: np.ndarray, large: bool) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64)), "large": pa.array(np.full(len(a), large))})


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint and its 64 neighbours at one bit: two share one of these exactly if they differ in at most 2 bits."""
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(BITS, dtype=np.uint64)])
    for batch in batches:
        prints = column(batch, "print").to_numpy().view(np.uint64)
        for low in range(0, len(prints), 4096):
            own = prints[low:low + 4096]
            yield pa.record_batch({"key": pa.array((own[:, None] ^ flips).ravel().view(np.int64)),
                                   "print": pa.array(np.repeat(own, len(flips)).view(np.int64))})


def near_links(prints: DataFrame, most: int = MOST_DIFFERENT, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly those within ``most`` (at most 2) bits.

    ``prints`` holds each fingerprint once. Not all linked pairs come out, but enough to reach one from the other.
    """
    if not 0 <= most <= 2:
        raise ValueError("links are exact for at most 2 differing bits")
    width = shuffle_width(prints.sparkSession)
    plan = plan_parts(*bit_counts(prints), most)
    keyed = prints.select("print").mapInArrow(_keys(plan), "part int, key bigint, print bigint, guest boolean")
    met = (keyed.repartition(width, "part", "key").sortWithinPartitions("part", "key", "guest")
           .mapInArrow(_bucket_links(most, bucket), "a bigint, b bigint, large boolean"))
    met = staged(met, "simhash-links")
    large = met.filter("large").select(F.col("a").alias("print")).distinct()
    flips = large.mapInArrow(_variants, "key bigint, print bigint")
    if most < 2:
        flips = flips.filter(F.lit(False))
        if met.filter("large").limit(1).count():
            raise ValueError("a bucket is larger than the comparison limit; raise it for fewer than 2 differing bits")
    stars = flips.groupBy("key").agg(F.min("print").alias("b"), F.collect_list("print").alias("all"))
    far = stars.filter(F.size("all") > 1).select(F.explode("all").alias("a"), "b").filter("a != b")
    return met.filter("not large").select("a", "b").unionByName(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    most: int = MOST_DIFFERENT, bucket: int = BUCKET) -> DataFrame:
    """Components of documents whose fingerprints link, directly or through others, at ``most`` differing bits.

    Returns (id, fingerprint as 16 hex digits, component_id: the smallest id reachable).

    How: copies share a fingerprint, so everything after the first step runs over
    distinct fingerprints. Bit and bit-pair counts over all of them group
    correlated bits into parts; dynamic programming gives each part its threshold by
    estimated candidates; fingerprints meet on their parts' values and are
    compared in full. A bucket of more than ``bucket`` fingerprints is linked through
    shared one-bit neighbours instead (65 rows each, at most 65 to a neighbour),
    which is exact too. Links then run through rounds of star contraction.

    Null and blank texts have fingerprint zero and link like any other. A null id
    belongs to its component but is never its name, unless all ids there are null.
    Rows with one id are each placed by their own text. Other columns are ignored.
    """
    rows = staged(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    distinct = staged(rows.groupBy("print").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(near_links(distinct, most, bucket), "a", "b")
    named = distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.join(least, "root").select("print", "component_id")
    return rows.join(names, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
