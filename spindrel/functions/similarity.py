"""Sequence similarity and edit runs: the two comparisons Spark has no operator for."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity; the order of the arguments matters."""
    return _ratio(a, b)


def ratio_bound(a: Column, b: Column) -> Column:
    """No ratio is larger; native, for use before ratio()."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.least(F.length(a), F.length(b)) / total)


_RUNS = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("text", T.StringType())]))


def _runs(x: str | None, y: str | None) -> list[dict]:
    a, b = (re.findall(r"\S+\s*", s or "") for s in (x, y))
    runs = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
        if op == "equal":
            runs.append({"op": "keep", "text": "".join(a[i:j])})
        else:
            runs += [{"op": o, "text": "".join(t)} for o, t in (("del", a[i:j]), ("add", b[k:m])) if t]
    return runs


@F.pandas_udf(_RUNS)
def token_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """Runs of kept, deleted and added text between two cells, by word."""
    return pd.Series([_runs(x, y) for x, y in zip(old, new, strict=True)])


@F.pandas_udf(T.ArrayType(_RUNS))
def token_diffs(old: pd.Series, new: pd.Series) -> pd.Series:
    """token_diff() of two lists of equal length, place by place."""
    return pd.Series([[_runs(x, y) for x, y in zip(a, b, strict=True)] for a, b in zip(old, new, strict=True)])


# as if it were not deterministic: otherwise the optimizer copies it into filters on its result, where Python cannot be called
token_diffs = token_diffs.asNondeterministic()
