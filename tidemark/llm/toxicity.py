"""Toxicity by a classifier chain over word features."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import fit_logistic, predict
from tidemark.llm.staging import column, id_and_text, pieces, text_column, tidy

#: Words that place a toxic text in a category. A category's label is: labelled toxic, and one of its words occurs.
CATEGORIES = {
    "insult": "idiot moron loser clown scum trash fool jerk imbecile vermin coward creep rat pig".split(),
    "contempt": "stupid pathetic worthless disgusting dumb useless filthy ugly ridiculous despicable shameful vile".split(),
}
LAST = "toxic"
#: Labelled rows that the models are fitted on, chosen by a hash of the id; a documented bound, the only one.
MOST_LABELLED = 20_000
VOCABULARY, LEAST_ROWS, FOLDS, THRESHOLD, PENALTY = 512, 5, 4, 0.3, 0.2

#: Word beginnings of so many bytes are counted, and a feature says that so many of a text's distinct words share one.
BEGINNINGS, COUNTS = (4, 6), (1, 2, 4)

_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    """Distinct lower-cased words; ASCII characters other than letters and digits part them."""
    return set(text.lower().encode().translate(_SEPARATORS).split())


def beginnings(words: set[bytes]) -> Counter:
    """How many of the words share each beginning: stems with varying ends."""
    return Counter([w[:k] for k in BEGINNINGS for w in words if len(w) > k])


def features_of(text: str) -> set[bytes]:
    """Words, and (beginning, 0, count) for each count that is reached."""
    words = words_of(text)
    return words | {b"%b\0%d" % (start, least) for start, n in beginnings(words).items() for least in COUNTS if n >= least}


@dataclass
class Chain:
    """A vocabulary and one weight vector for each category, whose inputs are the words and the probabilities before it."""

    vocabulary: dict[bytes, int]
    names: list[str]
    weights: list[np.ndarray]

    def matrix(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)))
        for i, text in enumerate(texts):
            x[i, places(self.vocabulary, text)] = 1
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        for w in self.weights:
            x = np.hstack([x, predict(x, w)[:, None]])
        return x[:, len(self.vocabulary):]


def places(vocabulary: dict[bytes, int], text: str) -> list[int]:
    """The places of the text's features in the vocabulary."""
    return sorted(vocabulary[f] for f in vocabulary.keys() & features_of(text))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(text_column(part).to_pylist(), column(part, "label").to_pylist()):
                counts[label].update(features_of(text))
            for label, own in counts.items():
                yield pa.record_batch({"word": pa.array(list(own), pa.binary()), "label": pa.array([label] * len(own), pa.int32()),
                                       "n": pa.array(list(own.values()), pa.int64())})


def telling_words(rows: DataFrame, most: int = VOCABULARY) -> list[bytes]:
    """The features whose document counts differ most between the classes (likelihood ratio), counted in Spark."""
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = float(size.get(0, 0)), float(size.get(1, 0))
    if not n0 or not n1:
        return []
    counts = rows.mapInArrow(tidy(_word_counts), "word binary, label int, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b")).filter(F.col("a") + F.col("b") >= LEAST_ROWS)

    def part(seen: str, total: float) -> F.Column:
        expected = (F.col("a") + F.col("b")) * total / (n0 + n1)
        inside = F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) / expected)).otherwise(0.0)
        left, rest = total - F.col(seen), total - expected
        return inside + F.when(left > 0, left * F.log(left / rest)).otherwise(0.0)

    ranked = counts.withColumn("gain", F.round(part("a", n1) + part("b", n0), 9)).orderBy(F.desc("gain"), "word")
    return [bytes(r["word"]) for r in ranked.select("word").limit(most).collect()]


def _listed(vocabulary: dict[bytes, int], categories: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = [{w.encode() for w in words} for words in categories.values()]
        for batch in batches:
            found, marks = [], []
            for text in text_column(batch).to_pylist():
                words = words_of(text)
                found.append(places(vocabulary, text))
                marks.append([bool(words & s) for s in sets])
            yield pa.record_batch({"id": column(batch, "id"), "label": column(batch, "label"), "found": pa.array(found, pa.list_(pa.int32())),
                                   "marks": pa.array(marks, pa.list_(pa.bool_()))})

    return run


def fit_chain(x: np.ndarray, targets: list[np.ndarray], fold: np.ndarray) -> list[np.ndarray]:
    """One model for each target. A later one sees what models that had not seen a row predict for it."""
    weights = []
    for target in targets:
        weights.append(fit_logistic(x, target, PENALTY))
        unseen = np.zeros(len(x))
        for k in np.unique(fold):
            held = fold == k
            other = fit_logistic(x[~held], target[~held], PENALTY) if (~held).any() else weights[-1]
            unseen[held] = predict(x[held], other)
        x = np.hstack([x, unseen[:, None]])
    return weights


def held_out(name: str = "id") -> F.Column:
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          categories: dict[str, list[str]] | None = None, most_labelled: int = MOST_LABELLED) -> Chain:
    """Fit the chain on labelled rows outside the held-out fifth (crc32 of the id modulo 5 is 0).

    At most ``most_labelled`` rows, those with the smallest hash of their id, are used; only they are read as texts,
    and their words' places come to the driver. Labels other than 0 and 1, null ids and labels without a text
    are left out; of repeated labels the larger counts. Without labels of both classes all probabilities are near the class's share, or 0.
    """
    categories = CATEGORIES if categories is None else categories
    usable = labels.select(F.col(id_col).cast("bigint").alias("label_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("label_id").agg(F.max("label").alias("label"))
    sample = usable.filter(~held_out("label_id")).orderBy(F.xxhash64("label_id"), "label_id").limit(most_labelled)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), F.col("id") == F.col("label_id")).select("id", "text", "label")
    vocabulary = {w: i for i, w in enumerate(telling_words(rows))}
    listed = rows.mapInArrow(tidy(_listed(vocabulary, categories)), "id bigint, label int, found array<int>, marks array<boolean>")
    got = listed.orderBy(F.xxhash64("id"), "id").limit(most_labelled).collect()
    names = [*categories, LAST]
    if not got:
        return Chain({}, names, [np.concatenate([np.zeros(k), [-20.0]]) for k in range(len(names))])
    x = np.zeros((len(got), len(vocabulary)))
    for i, row in enumerate(got):
        x[i, row["found"]] = 1
    toxic = np.array([r["label"] for r in got], float)
    marks = np.array([r["marks"] for r in got], float).reshape(len(got), len(categories))
    fold = np.arange(len(got)) % FOLDS
    return Chain(vocabulary, names, fit_chain(x, [*(toxic * m for m in marks.T), toxic], fold))


def _scored(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        for batch in batches:
            for part in pieces(batch):
                p = chain.probabilities(chain.matrix(text_column(part).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.ascontiguousarray(c)) for c in p.T)],
                                                 names=["row", *chain.names])

    return run


def score(docs: DataFrame, chain: Chain, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns named in ``keep``, and ``p_<category>`` for each category in order. Null text is empty. All of a text counts."""
    own = docs.select(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.lit(0).alias("one")).alias("row"),
                      F.col(text_col).cast("string").alias("text"))
    kind = own.schema["row"].dataType.simpleString()
    got = own.mapInArrow(tidy(_scored(chain)), f"row {kind}, " + ", ".join(f"`{n}` double" for n in chain.names))
    return got.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(keep)), *(F.col(n).alias(f"p_{n}") for n in chain.names))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
             threshold: float = THRESHOLD) -> DataFrame:
    """(id and kept columns, p_<category> ..., toxic): a document is toxic if the last probability reaches the threshold.

    How: word statistics of the labelled sample come from Spark; the chain's models are fitted in turn, each later
    one with out-of-fold probabilities of those before; all documents are scored row by row without a shuffle.
    Null, empty, repeated and unlabelled rows are scored like any other; an empty table gives no rows.
    """
    chain = train(docs, labels, id_col, text_col)
    return score(docs, chain, text_col, tuple(dict.fromkeys((id_col, *keep)))).withColumn("toxic", F.col(f"p_{LAST}") >= threshold)
