"""Tallies of a run, taken while its rows pass by and without their contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from evidentia import dims


def tallied(decisions: DataFrame) -> tuple[DataFrame, Observation]:
    """decisions, and an observation of rows, held cases and labels that is filled when an action runs over them."""
    seen = Observation("decisions")
    labels = [F.count_if(F.col("adjudication") == x).alias(x.lower()) for x in dims.LABELS]
    held = F.count_if(F.col("path").isin(*dims.UNDERDETERMINED)).alias("underdetermined")
    return decisions.observe(seen, F.count(F.lit(1)).alias("rows"), held, *labels), seen
