"""Standardisation with the population deviation (MLlib's scaler uses the sample deviation)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    mean: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(self.mean[c])) / F.lit(self.scale[c]) for c in self.mean
        })


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregate; two numbers per column come back to the driver. A constant column keeps scale 1."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"m_{c}"] or 0.0 for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns}
    )
