"""ROUGE-1, ROUGE-2 and ROUGE-L of two text columns (Lin 2004).

Scoring is row-local: one Arrow pandas UDF, no shuffle. The longest common
subsequence is computed bit-parallel on whole texts (Hyyrö 2004), so its cost is
tokens x tokens / 64 machine words.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.stemming import stem

METRICS = tuple(f"rouge{kind}_{part}" for kind in ("1", "2", "L") for part in ("precision", "recall", "fmeasure"))
_SCHEMA = ", ".join(f"{m} double" for m in METRICS)
_WORD = re.compile("[a-z0-9]+")


@lru_cache(maxsize=1 << 18)
def _stemmed(token: str) -> str:
    return stem(token) if len(token) > 3 else token


def rouge_tokens(text: str, use_stemmer: bool) -> list[str]:
    words = _WORD.findall(text.lower())
    return [_stemmed(w) for w in words] if use_stemmer else words


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; bit i of the state stands for a[i]."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for token in b:
        hit = places.get(token)
        if hit:
            common = state & hit
            state = ((state + common) | (state - common)) & full
    return len(a) - state.bit_count()


def triple(overlap: int, target: int, prediction: int) -> tuple[float, float, float]:
    precision = overlap / prediction if prediction else 0.0
    recall = overlap / target if target else 0.0
    both = precision + recall
    return precision, recall, 2 * precision * recall / both if both else 0.0


def score_pair(target: str, prediction: str, use_stemmer: bool = True) -> tuple[float, ...]:
    t, p = rouge_tokens(target, use_stemmer), rouge_tokens(prediction, use_stemmer)
    out: list[float] = []
    for n in (1, 2):
        grams_t = Counter(zip(*[t[i:] for i in range(n)]))
        grams_p = Counter(zip(*[p[i:] for i in range(n)]))
        overlap = (grams_t & grams_p).total()
        out += triple(overlap, grams_t.total(), grams_p.total())
    out += triple(lcs_length(t, p), len(t), len(p))
    return tuple(out)


def rouge(target: Column, prediction: Column, use_stemmer: bool = True) -> Column:
    """Struct of the nine scores; see ``METRICS``."""

    @F.pandas_udf(_SCHEMA)
    def scores(targets: pd.Series, predictions: pd.Series) -> pd.DataFrame:
        rows = [score_pair(t, p, use_stemmer) for t, p in zip(targets, predictions)]
        return pd.DataFrame(rows, columns=list(METRICS), dtype="float64")

    # The mark keeps the optimizer from copying the call into filters.
    once = scores.asNondeterministic()
    return once(F.coalesce(target, F.lit("")), F.coalesce(prediction, F.lit("")))
