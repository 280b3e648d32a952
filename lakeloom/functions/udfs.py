"""Scalar functions written in Python, run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F


def string_udf(function: Callable[[str], str]) -> Callable:
    """Make a column function of a plain ``str -> str`` function.

    Nulls stay null and never reach the function. Within a batch it runs once per distinct value.
    """

    def apply(values: pd.Series) -> pd.Series:
        results = {value: function(value) for value in values.dropna().unique()}
        return values.map(results).astype(object)

    apply.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, "string")
