"""Second-order boosted trees: histograms of gradients added up in Spark, one pass a level, and attributions of their predictions."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.operators.models import CATEGORICAL, LABEL, LEARNING_RATE, NUMERIC, TREE_DEPTH, TREES
from tidemark.session import checkpointed

#: Bins of a number, trees between two writings of the rows' margins, and features of a path whose patterns of known ones are listed.
BINS, WRITE_EVERY, LISTED = 256, 4, 10


class Levels:
    """A category of many rows as places in its list of levels, so that a level is compared as a number."""

    def __init__(self, codes: np.ndarray, places: dict[str, int]):
        self.codes, self.places = codes, places

    def __len__(self) -> int:
        return len(self.codes)

    def __getitem__(self, rows: np.ndarray) -> Levels:
        return Levels(self.codes[rows], self.places)

    def __eq__(self, level: str) -> np.ndarray:
        return self.codes == self.places.get(level, -1)


@dataclass
class Tree:
    """Nodes side by side: a split goes left where a number is below ``at`` (or missing), or a category equals ``level``."""

    feature: list[int] = field(default_factory=list)  # -1 for a leaf
    at: list[float | None] = field(default_factory=list)
    level: list[str | None] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, cover: float) -> int:
        for column, empty in ((self.feature, -1), (self.at, None), (self.level, None), (self.left, -1), (self.value, 0.0)):
            column.append(empty)
        self.cover.append(cover)
        return len(self.cover) - 1

    def goes_left(self, node: int, columns: list[np.ndarray]) -> np.ndarray:
        return self._left(node, columns[self.feature[node]])

    def _left(self, node: int, values: np.ndarray | Levels) -> np.ndarray:
        return ~(values >= self.at[node]) if self.level[node] is None else values == self.level[node]

    def nodes(self, columns: list[np.ndarray]) -> np.ndarray:
        """The leaf (or the last node so far) of each row."""
        here = np.zeros(len(columns[0]), np.int64)
        for node, feature in enumerate(self.feature):  # children come after their parents
            if feature >= 0:
                own = np.flatnonzero(here == node)
                left = self._left(node, columns[feature][own])
                here[own] = self.left[node] + ~left
        return here


@dataclass
class BoostedTrees:
    """A model: ``base`` and the trees' values add up to the prediction."""

    numeric: list[str]
    categorical: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        made = json.loads(text)
        return BoostedTrees(made["numeric"], made["categorical"], made["base"], [Tree(**t) for t in made["trees"]])

    def margins(self, columns: list[np.ndarray], first: int = 0) -> np.ndarray:
        out = np.zeros(len(columns[0]))
        for tree in self.trees[first:]:
            out += np.array(tree.value)[tree.nodes(columns)]
        return out


def _levels(column: pa.Array) -> Levels:
    named = column.fill_null("").dictionary_encode()
    return Levels(named.indices.to_numpy(zero_copy_only=False), {name: i for i, name in enumerate(named.dictionary.to_pylist())})


def _columns(batch: pa.RecordBatch, numeric: int, categorical: int) -> list[np.ndarray | Levels]:
    """The features of a batch: numbers with missing as not-a-number, categories with missing as an empty text."""
    numbers = [batch.column(i).cast(pa.float64()).fill_null(math.nan).to_numpy() for i in range(numeric)]
    return numbers + [_levels(batch.column(i)) for i in range(numeric, numeric + categorical)]


def _features(model: BoostedTrees) -> list[Column]:
    return [*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(model.numeric)),
            *(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(model.categorical))]


def bin_edges(train: DataFrame, numeric: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Where numbers are cut: all distinct values but the least if there are few, else quantiles; at most ``bins`` - 1 a feature."""
    edges = []
    for name in numeric:
        some = train.select(F.col(name).cast("double").alias("v")).filter("v is not null and not isnan(v)")
        few = [r["v"] for r in some.distinct().limit(bins + 1).collect()]
        if len(few) > bins:
            few = some.approxQuantile("v", [i / bins for i in range(bins)], 0.25 / bins)
        edges.append(np.unique(few)[1:])
    return edges


def _histograms(model: BoostedTrees, tree: Tree, open_nodes: list[int], edges: list[np.ndarray], written: int, most: int):
    """Sums of gradients and rows for each open node, feature and bin or level: one set a task for numbers."""
    numeric, categorical = len(model.numeric), len(model.categorical)
    place = {node: i for i, node in enumerate(open_nodes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(open_nodes), numeric, most))
        for batch in batches:
            columns = _columns(batch, numeric, categorical)
            margin, label = (batch.column(numeric + categorical + i).to_numpy() for i in (0, 1))
            gradient = margin + model.margins(columns, written) - label
            slot = np.array([place.get(n, -1) for n in range(len(tree.feature))])[tree.nodes(columns)]
            keep = slot >= 0
            slot, gradient = slot[keep], gradient[keep]
            for f in range(numeric):
                cell = slot * most + np.where(np.isnan(columns[f][keep]), 0, np.searchsorted(edges[f], columns[f][keep], side="right"))
                for k, weights in ((0, gradient), (1, None)):
                    sums[k, :, f] += np.bincount(cell, weights, len(open_nodes) * most).reshape(len(open_nodes), most)
            for f in range(categorical):
                levels, code = np.array(list(columns[numeric + f].places), object), columns[numeric + f].codes[keep]
                cell = slot * len(levels) + code
                count = np.bincount(cell, minlength=len(open_nodes) * len(levels))
                total = np.bincount(cell, gradient, len(open_nodes) * len(levels))
                used = np.flatnonzero(count)
                yield _sums(used // max(1, len(levels)), numeric + f, None, levels[used % max(1, len(levels))], total[used], count[used])
        for f in range(numeric):
            node, cell = np.nonzero(sums[1, :, f])
            yield _sums(node, f, cell, None, sums[0, node, f, cell], sums[1, node, f, cell])

    return run


def _sums(node, feature: int, cell, level, g, h) -> pa.RecordBatch:
    n = len(node)
    return pa.record_batch({
        "node": pa.array(np.asarray(node, np.int32)), "feature": pa.array(np.full(n, feature, np.int32)),
        "bin": pa.array(np.full(n, -1, np.int32) if cell is None else np.asarray(cell, np.int32)),
        "level": pa.array([None] * n if level is None else list(level), pa.string()),
        "g": pa.array(np.asarray(g, float)), "h": pa.array(np.asarray(h, float))})


def _best_splits(sums: DataFrame, totals: list[tuple[float, float]], l2: float, least_cover: float) -> list:
    """The best split of each open node, in Spark: numbers by running sums over their bins, each level against all others."""
    added = sums.repartition("node", "feature").groupBy("node", "feature", "bin", "level").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    numbers = added.filter("bin >= 0").withColumns({"gl": F.sum("g").over(upto), "hl": F.sum("h").over(upto)})
    levels = added.filter("bin < 0").withColumns({"gl": F.col("g"), "hl": F.col("h")})
    all_g, all_h = (F.array(*(F.lit(float(t[k])) for t in totals))[F.col("node")] for k in (0, 1))

    def score(g: Column, h: Column) -> Column:
        return g * g / (h + l2)

    gr, hr = all_g - F.col("gl"), all_h - F.col("hl")
    gain = score(F.col("gl"), F.col("hl")) + score(gr, hr) - score(all_g, all_h)
    # Sums of doubles differ in their last digits with the order of tasks: nearly equal gains go to the first feature and place.
    found = numbers.unionByName(levels).filter((F.col("hl") >= least_cover) & (hr >= least_cover)).withColumn("gain", F.round(gain, 6)).filter("gain > 0")
    rank = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "level", "gl", "hl")
    return found.groupBy("node").agg(F.max(rank).alias("best")).collect()  # one row an open node


def fit_second_order_trees(train: DataFrame, label: str = LABEL, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL,
                           trees: int = TREES, rate: float = LEARNING_RATE, depth: int = TREE_DEPTH, l2: float = 1.0,
                           least_gain: float = 0.0, least_cover: float = 1.0, bins: int = BINS) -> BoostedTrees:
    """Boosted trees for squared error by gradients and second derivatives, with gains regularised by ``l2``.

    Each level of a tree takes one pass over the rows: tasks add up their rows' gradients by open node, feature and bin, Spark
    adds up the tasks and picks each node's best split, and one row a node comes to the driver. A category's levels are split one
    against all others, however many there are. Rows' margins are written every four trees, so a pass evaluates four at most.
    Rows without a label are left out; a missing number goes left, a missing category is a level of its own.
    """
    rows = train.filter(F.col(label).isNotNull())
    start = rows.agg(F.avg(F.col(label).cast("double")).alias("base"), F.count("*").alias("n")).first()
    model = BoostedTrees(list(numeric), list(categorical), float(start["base"] or 0.0))
    edges = bin_edges(rows, numeric, bins)
    most = max([len(e) + 1 for e in edges], default=1)
    staged = checkpointed(rows.select(*_features(model), F.lit(model.base).alias("margin"), F.col(label).cast("double").alias("label")))
    total, written = (0.0, float(start["n"])), 0
    for number in range(trees if start["n"] else 0):
        tree = Tree()
        sums = {tree.add(total[1]): total}
        open_nodes = [0]
        for _ in range(depth):
            parts = staged.mapInArrow(_histograms(model, tree, open_nodes, edges, written, most),
                                      "node int, feature int, bin int, level string, g double, h double")
            children = []
            for row in sorted(_best_splits(parts, [sums[n] for n in open_nodes], l2, least_cover), key=lambda r: r["node"]):
                node, best = open_nodes[row["node"]], row["best"]
                if best["gain"] <= 2 * least_gain:
                    continue
                g, h = sums[node]
                tree.feature[node] = f = -best["f"]
                tree.level[node], tree.at[node] = (best["level"], None) if f >= len(model.numeric) else (None, float(edges[f][-best["b"]]))
                tree.left[node] = tree.add(best["hl"])
                right = tree.add(h - best["hl"])
                sums[tree.left[node]], sums[right] = (best["gl"], best["hl"]), (g - best["gl"], h - best["hl"])
                children += [tree.left[node], right]
            open_nodes = children
            if not open_nodes:
                break
        leaves = [n for n, f in enumerate(tree.feature) if f < 0]
        for n in leaves:
            tree.value[n] = -rate * sums[n][0] / (sums[n][1] + l2)
        model.trees.append(tree)
        total = (sum(sums[n][0] + tree.value[n] * sums[n][1] for n in leaves), total[1])
        if len(model.trees) - written >= WRITE_EVERY and number + 1 < trees:
            staged = checkpointed(_with_margins(staged, model, written))
            written = len(model.trees)
    return model


def _with_margins(staged: DataFrame, model: BoostedTrees, written: int) -> DataFrame:
    numeric, categorical = len(model.numeric), len(model.categorical)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = model.margins(_columns(batch, numeric, categorical), written)
            at = numeric + categorical
            yield batch.set_column(at, batch.schema.field(at), pa.array(batch.column(at).to_numpy() + more))

    return staged.mapInArrow(run, staged.schema)


def _per_row(model: BoostedTrees, rows: DataFrame, keep: Sequence[str], fields: list[StructField], make) -> DataFrame:
    own = rows.select(*_features(model), *keep)
    schema = StructType([*own.schema.fields[-len(keep):], *fields] if keep else fields)
    at = len(model.numeric) + len(model.categorical)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = [batch.column(at + i) for i in range(len(keep))]
                made = make(_columns(batch, len(model.numeric), len(model.categorical)))
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(m) for m in made)], names=schema.names)

    return own.mapInArrow(run, schema)


def predict_trees(model: BoostedTrees, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns and ``prediction``; no shuffle."""
    return _per_row(model, rows, keep, [StructField("prediction", DoubleType())], lambda columns: [model.base + model.margins(columns)])


def tree_shares(tree: Tree, columns: list[np.ndarray]) -> np.ndarray:
    """(rows, features): Shapley values of one tree's prediction, where a feature that isn't known follows the training rows' shares.

    A leaf's value is shared by the features on its path. A feature's ``known`` is 1 for rows that pass all its splits there, its
    ``share`` the product of the training rows' shares; the weights of the subsets of the others come from a polynomial.
    """
    out = np.zeros((len(columns[0]), len(columns)))

    def walk(node: int, path: dict[int, tuple[np.ndarray, float]]) -> None:
        f = tree.feature[node]
        if f >= 0:
            left = tree.goes_left(node, columns)
            known, share = path.get(f, (np.ones(len(out), bool), 1.0))
            for child, passes in ((tree.left[node], left), (tree.left[node] + 1, ~left)):
                walk(child, path | {f: (known & passes, share * tree.cover[child] / tree.cover[node])})
            return
        m = len(path)
        if not m:
            return
        known, shares = np.stack([k for k, _ in path.values()]), [s for _, s in path.values()]
        # Rows with the same features known have the same weights, so these are made once a pattern.
        listed = m <= LISTED
        seen = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(bool) if listed else known.T
        place = (known * (1 << np.arange(m, dtype=np.int32))[:, None]).sum(axis=0) if listed else slice(None)
        order = np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])
        for i, f in enumerate(path):
            weights = np.zeros((len(seen), m))
            weights[:, 0] = 1
            for j in range(m):
                if j != i:
                    weights[:, 1:] = weights[:, 1:] * shares[j] + weights[:, :-1] * seen[:, j, None]
                    weights[:, 0] *= shares[j]
            out[:, f] += (tree.value[node] * (seen[:, i] - shares[i]) * (weights @ order))[place]

    walk(0, {})
    return out


def expected_value(model: BoostedTrees) -> float:
    """The prediction where no feature is known: the training rows' mean of the trees' values, and the base."""
    return model.base + sum(v * c / t.cover[0] for t in model.trees for f, v, c in zip(t.feature, t.value, t.cover) if f < 0)


def tree_attributions(model: BoostedTrees, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns and one column a feature: how much it moves the prediction from ``expected_value``; no shuffle."""
    names = [*model.numeric, *model.categorical]

    def make(columns: list[np.ndarray]) -> list[np.ndarray]:
        out = np.zeros((len(columns[0]), len(columns)))
        for tree in model.trees:
            out += tree_shares(tree, columns)
        return list(out.T)

    return _per_row(model, rows, keep, [StructField(f"by_{n}", DoubleType()) for n in names], make)


def save_trees(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(path)


def load_trees(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.from_json(spark.read.text(path).first()["value"])
