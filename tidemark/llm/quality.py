"""Quality by positive-unlabelled learning with the non-negative unbiased risk."""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import sigmoid
from tidemark.llm.staging import column, id_and_text, lists, pieces, staged, text_column

#: Cut points of each measure, at equal shares of the unlabelled texts.
CUTS = 9
THRESHOLD, PENALTY, STEPS = 0.3, 1e-4, 25
#: A term of the risk below -BETA is corrected before the risk is lowered again.
BETA = 0.0

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
_DIGITS = b"0123456789"
_ENDS = b".,;:?'\"-() \n\t\r"
MEASURES = ("words", "word_length", "capitals", "symbols", "digits", "distinct_words", "top_word", "repeated_pairs",
            "repeated_lines", "packed", "single_letters", "odd_endings", "marked_words", "stops")


def measures(text: str) -> list[float]:
    """What is measured of a whole text; shares are between 0 and 1."""
    data = text.encode()
    words = data.split()
    n, size = max(len(words), 1), max(len(data), 1)

    def share(kept: bytes) -> float:
        return (len(data) - len(data.translate(None, kept))) / size

    letters = share(_LETTERS)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in data.split(b"\n") if line]
    pack = zlib.compressobj(1)
    packed = len(pack.compress(data)) + len(pack.flush())
    odd = sum(w[-1] not in _LETTERS and w[-1] not in _ENDS and w[-1] not in _DIGITS for w in counts)
    marked = sum(c for w, c in counts.items() if w[-2:] in _DOUBLES or len(w) == 1 and w not in _SHORT)
    return [
        np.log1p(len(words)), size / n, share(_UPPER) / max(letters, 1e-9), 1 - letters - share(_DIGITS) - share(_ENDS), share(_DIGITS),
        len(counts) / n, max(counts.values(), default=0) / n, 1 - (pairs + 1) / n if len(words) > 1 else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0, packed / size, sum(c for w, c in counts.items() if len(w) == 1) / n,
        odd / max(len(counts), 1), marked / n, (data.count(b".") + data.count(b"?")) / n]


#: A doubled mark at a word's end, and one-character words that are ordinary.
_DOUBLES = {bytes([c, c]) for c in b"!#$%&*+/<=>?@\\^_`|~"}
_SHORT = {b"a", b"A", b"I", b"y", b"e", b"o", b"u", b"&"}


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            rows = np.array([measures(t) for t in text_column(part).to_pylist()], np.float32)
            yield pa.record_batch({"id": column(part, "id"), "positive": column(part, "positive"), "unlabelled": column(part, "unlabelled"),
                                   "m": lists(rows.ravel(), np.arange(1, len(rows) + 1) * rows.shape[1], pa.float32())})


@dataclass
class Model:
    """Cut points for each measure, and a weight for each cut passed, with a constant at the end."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    prior: float

    def inputs(self, m: np.ndarray) -> np.ndarray:
        parts = [m[:, k:k + 1] > own[None, :] for k, own in enumerate(self.cuts)]
        return np.hstack([*parts, np.ones((len(m), 1), bool)]).astype(np.float64)

    def margins(self, m: np.ndarray) -> np.ndarray:
        return self.inputs(m) @ self.weights


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return column(batch, "m").flatten().to_numpy().reshape(batch.num_rows, len(MEASURES))


def _moments(model: Model):
    """Sums over positives and unlabelled rows of what risk, gradient and Hessian need; one list for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        d = len(model.weights)
        sums = {side: [0.0, 0.0, 0.0, np.zeros(d), np.zeros(d), np.zeros((d, d))] for side in ("positive", "unlabelled")}
        for batch in batches:
            x = model.inputs(_matrix(batch))
            z = x @ model.weights
            p = sigmoid(z)
            for side, s in sums.items():
                own = column(batch, side).to_numpy(zero_copy_only=False)
                xs, zs, ps = x[own], z[own], p[own]
                s[0] += len(zs)
                s[1] += zs.sum()
                s[2] += np.logaddexp(0, zs).sum()
                s[3] += xs.sum(axis=0)
                s[4] += xs.T @ ps
                s[5] += (xs * (ps * (1 - ps))[:, None]).T @ xs
        flat = np.concatenate([np.concatenate([s[:3], s[3], s[4], s[5].ravel()]) for s in sums.values()])
        yield pa.record_batch({"place": pa.array(np.arange(len(flat))), "value": pa.array(flat)})

    return run


def _totals(rows: DataFrame, model: Model) -> dict[str, tuple]:
    d = len(model.weights)
    summed = rows.mapInArrow(_moments(model), "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(2 * (3 + 2 * d + d * d))
    for row in summed:
        flat[row["place"]] = row["value"]
    out = {}
    for side, own in zip(("positive", "unlabelled"), np.split(flat, 2)):
        n = max(own[0], 1.0)
        out[side] = (own[0], *(own[1:3] / n), own[3:3 + d] / n, own[3 + d:3 + 2 * d] / n, own[3 + 2 * d:].reshape(d, d) / n)
    return out


def minimise(rows: DataFrame, model: Model, prior: float) -> tuple[Model, float]:
    """Lower the non-negative unbiased risk by Newton steps; returns the model of the least risk met.

    With logistic loss l and class prior p the risk is p E+[l(z)] + max(0, Eu[l(-z)] - p E+[l(-z)]). The bracket estimates
    the risk on negatives; where it falls below zero the step raises it instead, as it can't be negative in truth.
    """
    d = len(model.weights)
    ridge = np.full(d, PENALTY)
    ridge[-1] = 1e-9
    w, best, shrink = model.weights, (np.inf, model.weights), 1.0
    for _ in range(STEPS):
        totals = _totals(rows, Model(model.cuts, w, prior))
        (_, pz, plog, px, ppx, phess), (_, _, ulog, _, upx, uhess) = totals["positive"], totals["unlabelled"]
        negative = ulog - prior * plog
        risk = prior * (plog - pz) + max(0.0, negative) + ridge @ (w * w) / 2
        if risk < best[0] - 1e-7:
            gain, best, shrink = best[0] - risk, (risk, w), 1.0
        else:
            gain, shrink = np.inf, shrink / 2
            if shrink < 1e-2:
                break
        if gain < 1e-6:
            break
        w = best[1] if shrink < 1 else w
        if negative < -BETA:
            ascent = upx - prior * ppx
            w = w + 0.5 * ascent
            continue
        gradient = upx - prior * px + ridge * w
        if shrink == 1.0:
            step = np.linalg.solve(uhess + np.diag(ridge) + 1e-9 * np.eye(d), gradient)
            length = np.abs(step).max()
            step *= min(1.0, 4.0 / max(length, 1e-12))
        else:
            step = step * 0.5
        w = w - step
    return Model(model.cuts, best[1], prior), best[0]


def _histogram(model: Model, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, bins), np.int64)
        for batch in batches:
            p = sigmoid(model.margins(_matrix(batch)))
            place = np.minimum((p * bins).astype(np.int64), bins - 1)
            for k, side in enumerate(("positive", "unlabelled")):
                counts[k] += np.bincount(place[column(batch, side).to_numpy(zero_copy_only=False)], minlength=bins)
        yield pa.record_batch({"place": pa.array(np.arange(2 * bins)), "n": pa.array(counts.ravel())})

    return run


def estimate_prior(rows: DataFrame, model: Model, bins: int = 1000) -> float:
    """The share of positives among unlabelled rows: the least ratio of the shares above a score, over scores with support.

    Above a score where no negatives are left the ratio of unlabelled to positive shares is the prior; elsewhere
    it is larger. A margin for the counts' errors keeps thin tails from winning.
    """
    got = rows.mapInArrow(_histogram(model, bins), "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * bins)
    for row in got:
        counts[row["place"]] = row["n"]
    above = np.cumsum(counts.reshape(2, bins)[:, ::-1], axis=1)
    total = np.maximum(above[:, -1:], 1)
    share = above / total
    error = np.sqrt(np.log(4 / 0.1) / (2 * total))
    usable = share[0] > 0.1
    if not usable.any():
        return 0.5
    bound = share[1] / np.maximum(share[0], 1e-12) + error.sum() / np.maximum(share[0], 1e-12)
    at = np.flatnonzero(usable)[np.argmin(bound[usable])]
    return float(np.clip(share[1, at] / share[0, at], 0.02, 0.98))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on trusted positives (label 1) and unlabelled texts, both outside the held-out fifth (crc32 of the id modulo 5 is 0).

    Labels of 0 are not used. All rows take part: texts are measured once and staged as a few numbers, and each step
    of the fit sums over them in Spark. First a classifier of positives against unlabelled rows ranks
    texts, then the class prior is estimated from that ranking, then the risk is minimised with this prior.
    """
    trusted = labels.filter((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("trusted")).distinct()
    # The flags meet the documents' ids only; texts stay where they are read.
    own = id_and_text(docs, id_col, text_col)
    fresh = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 != 0, F.lit(True))
    measured = own.filter(fresh).withColumn("positive", F.lit(False)).withColumn("unlabelled", F.lit(True)).mapInArrow(
        _measured, "id bigint, positive boolean, unlabelled boolean, m array<float>")
    flagged = measured.join(trusted, F.col("id") == F.col("trusted"), "left").withColumn("positive", F.col("trusted").isNotNull()).drop("trusted")
    rows = staged(flagged, "quality")
    points = [(k + 1) / (CUTS + 1) for k in range(CUTS)]
    quantiles = rows.agg(*(F.percentile_approx(F.col("m")[k], points, 1000).alias(name) for k, name in enumerate(MEASURES))).first()
    cuts = [np.unique(np.array(quantiles[name] or [], np.float32)) for name in MEASURES]
    empty = Model(cuts, np.zeros(sum(map(len, cuts)) + 1), 0.5)
    if not rows.filter("positive").limit(1).count():
        return empty
    ranker, _ = minimise(rows, empty, 0.5)
    prior = estimate_prior(rows, ranker)
    return minimise(rows, empty, prior)[0]


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                m = np.array([measures(t) for t in text_column(part).to_pylist()], np.float32)
                yield pa.record_batch({"id": column(part, "id"), "score": pa.array(sigmoid(model.margins(m)))})

    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted): how likely each whole text is of good quality, from the text alone.

    Null text is empty and scored like any other; so are repeated and null ids. Without positives every score is
    0.5. Other columns are ignored. See ``train`` for the method.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    scored = id_and_text(docs, id_col, text_col).mapInArrow(_scored(model), "id bigint, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
