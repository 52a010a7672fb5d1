"""Python literals as JSON text."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def json_of_literal(text: str | None) -> str | None:
    """JSON of a Python literal: tuples and sets become lists, None is null, other keys than texts become texts. None where the
    text is no literal, or holds something that JSON has no form for (bytes, complex numbers)."""
    def plain(value):
        if isinstance(value, dict):
            return {k if isinstance(k, str) else json.dumps(plain(k)): plain(v) for k, v in value.items()}
        if isinstance(value, (list, tuple)):
            return [plain(v) for v in value]
        if isinstance(value, (set, frozenset)):
            return sorted((plain(v) for v in value), key=repr)
        if value is None or isinstance(value, (str, bool, int, float)):
            return value
        raise ValueError(f"no JSON for {type(value).__name__}")

    try:
        return None if text is None else json.dumps(plain(ast.literal_eval(text)), ensure_ascii=False, allow_nan=False)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _json_of_literals(texts: pd.Series) -> pd.Series:
    return texts.map(json_of_literal, na_action="ignore").astype(object)


def literal_json(c: Column) -> Column:
    """JSON of Python literals in a text column, null for other texts."""
    return _json_of_literals(c)
