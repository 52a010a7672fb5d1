"""Second-order trees: splits against brute force, attributions against all subsets, fit and round trip."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, models
from tidemark.session import scratch_path

SCHEMA = "id int, y double, a double, b double, c string, d string"


def data(n=300, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c, d = float(rng.integers(0, 30)), float(rng.normal()), str(rng.choice(["x", "y", "z"])), f"l{rng.integers(0, 40)}"
        rows.append((i, 2 * a + (5 if c == "x" else 0) + (3 * b if a > 10 else 0) + (7 if d == "l3" else 0), a if i % 11 else None, b, c if i % 7 else None, d))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(data(), SCHEMA).repartition(5).cache()


def brute_best(rows, gradients, l2, feature):
    """The best (gain, left rows) of one split over all features."""
    best = (0, None)
    for f in feature:
        values = [r[f] for r in rows]
        if isinstance(next(v for v in values if v is not None), float):
            cuts = [(lambda v, t=t: v is None or v < t) for t in sorted({v for v in values if v is not None})[1:]]
        else:
            cuts = [(lambda v, t=t: (v or "") == t) for t in sorted({v or "" for v in values})]
        for goes in cuts:
            left = np.array([goes(v) for v in values])
            if left.any() and not left.all():
                g, gl = gradients.sum(), gradients[left].sum()
                gain = gl ** 2 / (left.sum() + l2) + (g - gl) ** 2 / ((~left).sum() + l2) - g ** 2 / (len(rows) + l2)
                if gain > best[0] + 1e-5:
                    best = (gain, left)
    return best


def test_splits_are_the_best_of_all(spark, frame):
    rows = data()
    model = boosting.fit_second_order_trees(frame, "y", ["a", "b"], ["c", "d"], trees=2, rate=0.5, depth=2, bins=400)
    gradients = np.full(len(rows), model.base) - np.array([r[1] for r in rows])
    columns = [np.array([math.nan if r[i] is None else r[i] for r in rows]) for i in (2, 3)] + [np.array([r[i] or "" for r in rows], object) for i in (4, 5)]
    for tree in model.trees:
        groups = {0: np.arange(len(rows))}
        for node, feature in enumerate(tree.feature):
            own = groups[node]
            if feature < 0:
                assert tree.value[node] == pytest.approx(-0.5 * gradients[own].sum() / (len(own) + 1)) and tree.cover[node] == len(own)
                continue
            gain, _ = brute_best([rows[i] for i in own], gradients[own], 1.0, (2, 3, 4, 5))
            left = tree.goes_left(node, [c[own] for c in columns])
            g, gl = gradients[own].sum(), gradients[own][left].sum()
            made = gl ** 2 / (left.sum() + 1) + (g - gl) ** 2 / ((~left).sum() + 1) - g ** 2 / (len(own) + 1)
            assert made == pytest.approx(gain, abs=1e-3)
            groups[tree.left[node]], groups[tree.left[node] + 1] = own[left], own[~left]
        gradients = gradients + np.array(tree.value)[tree.nodes(columns)]


def test_attributions_equal_all_subsets(spark, frame):
    model = boosting.fit_second_order_trees(frame, "y", ["a", "b"], ["c", "d"], trees=3, rate=0.5, depth=3)
    got = boosting.tree_attributions(model, frame, ["id"]).join(boosting.predict_trees(model, frame, ["id"]), "id").orderBy("id").collect()
    rows = data()
    base = boosting.expected_value(model)

    def value(row, known):
        def walk(tree, node):
            f = tree.feature[node]
            if f < 0:
                return tree.value[node]
            left, right = tree.left[node], tree.left[node] + 1
            if f in known:
                return walk(tree, left if tree.goes_left(node, [np.array([x]) if k < 2 else np.array([x], object) for k, x in enumerate(row)])[0] else right)
            return (tree.cover[left] * walk(tree, left) + tree.cover[right] * walk(tree, right)) / tree.cover[node]
        return model.base + sum(walk(t, 0) for t in model.trees)

    for r in got[::23]:
        raw = rows[r.id][2:]
        row = [math.nan if raw[0] is None else raw[0], raw[1], raw[2] or "", raw[3] or ""]
        parts = [r.by_a, r.by_b, r.by_c, r.by_d]
        for f in range(4):
            others = [k for k in range(4) if k != f]
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (value(row, {*s, f}) - value(row, set(s)))
                       for n in range(4) for s in itertools.combinations(others, n))
            assert parts[f] == pytest.approx(want, abs=1e-9)
    assert all(sum((r.by_a, r.by_b, r.by_c, r.by_d)) == pytest.approx(r.prediction - base, abs=1e-9) for r in got)


def test_many_trees_fit_and_are_saved(spark, frame):
    model = boosting.fit_second_order_trees(frame, "y", ["a", "b"], ["c", "d"], trees=13, rate=0.4, depth=4)
    path = scratch_path(spark, "trees")
    boosting.save_trees(spark, model, path)
    again = boosting.load_trees(spark, path)
    scored = boosting.predict_trees(again, frame, ["id", "y"])
    assert again == model and models.regression_metrics(scored, "y").first().r2 > 0.95
    unseen = spark.createDataFrame([(1, None, None, None, "new", None)], SCHEMA)
    assert boosting.predict_trees(again, unseen, ["id"]).first().prediction is not None


def test_empty_and_constant_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = boosting.fit_second_order_trees(empty, "y", ["a"], ["c"], trees=3)
    assert model.trees == [] and boosting.predict_trees(model, empty, ["id"]).count() == 0
    same = empty.unionByName(spark.createDataFrame([(i, 4.0, 1.0, None, "x", None) for i in range(9)], SCHEMA))
    model = boosting.fit_second_order_trees(same, "y", ["a", "b"], ["c"], trees=2)
    assert {r.prediction for r in boosting.predict_trees(model, same, ["id"]).collect()} == {4.0}
    assert boosting.tree_attributions(model, same, ["id"]).agg(F.sum("by_a")).first()[0] == 0


def test_levels_are_compared_as_numbers_and_patterns_once(monkeypatch):
    """Each level of a tree passes over all rows: no text is compared or sorted there, and attributions are made once a pattern."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    n, levels = 2000, ["x", "y", "", "z"]
    drawn = rng.integers(0, 4, n)
    a, y = rng.normal(size=n), rng.normal(size=n)
    batch = pa.record_batch({"x0": pa.array(a), "c0": pa.array([levels[i] or None for i in drawn]), "margin": pa.array(np.zeros(n)), "label": pa.array(y)})
    columns = boosting._columns(batch, 1, 1)
    assert columns[1].codes.dtype.kind == "i" and ((columns[1] == "y") == (drawn == 1)).all() and not (columns[1] == "none").any()
    model = boosting.BoostedTrees(["a"], ["c"], 0.0)
    tree = boosting.Tree()
    tree.add(n)
    got = {(r["feature"], r["bin"], r["level"]): (r["g"], r["h"]) for b in boosting._histograms(model, tree, [0], [np.array([0.0])], 0, 2)(iter([batch]))
           for r in b.to_pylist()}
    for i, level in enumerate(levels):
        assert got[1, -1, level] == (pytest.approx(-y[drawn == i].sum()), (drawn == i).sum())
    assert got[0, 0, None] == (pytest.approx(-y[a < 0].sum()), (a < 0).sum())
    tree.feature, tree.at, tree.level, tree.left, tree.value, tree.cover = [0, 1, -1, -1, -1], [0.0] + [None] * 4, [None, "y"] + [None] * 3, [1, 3, -1, -1, -1], [
        0.0, 0.0, 2.0, 3.0, 5.0], [10.0, 6.0, 4.0, 1.0, 5.0]
    listed = boosting.tree_shares(tree, columns)
    monkeypatch.setattr(boosting, "LISTED", 0)
    assert np.allclose(listed, boosting.tree_shares(tree, columns))
