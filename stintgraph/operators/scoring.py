"""Scores of candidates: a fixed formula by default, any model by injection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stintgraph.functions.names import feature_columns, jaro_winkler, levenshtein_norm

#: Our own weights, not those of any trained model.
LAST, FIRST, FULL = 0.45, 0.35, 0.20


def default_score() -> Column:
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    pair = lambda n: (low(F.col(f"mention_{n}")), low(F.col(f"post_{n}")))
    full = [F.concat_ws(" ", low(F.col(f"{s}_first_name")), low(F.col(f"{s}_last_name"))) for s in ("mention", "post")]
    return F.round(LAST * jaro_winkler(*pair("last_name")) + FIRST * jaro_winkler(*pair("first_name")) + FULL * levenshtein_norm(*full), 6)


def scored(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("match_probability", default_score())


def features(candidates: DataFrame) -> DataFrame:
    return candidates.withColumns(feature_columns())


def scored_by(candidates: DataFrame, model: Callable[[pd.DataFrame], "pd.Series"], columns: list[str]) -> DataFrame:
    """``match_probability`` by ``model`` from those of ``columns`` that are there, in their order."""
    own = [c for c in columns if c in candidates.columns]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["match_probability"] = model(b[own]).to_numpy(dtype=float) if len(b) else pd.Series(dtype=float)
            yield b

    schema = StructType([*candidates.schema.fields, StructField("match_probability", DoubleType())])
    return candidates.mapInPandas(work, schema)
