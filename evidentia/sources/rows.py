"""Emitted rows as JSON lines, development dumps with their paths, and labels as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia import dims

ROW = "case_id string, " + ", ".join(f"{f} string" for f in dims.FIELDS) + ", risk_flags string, adjudication string, confidence double"
DEV = ROW + ", _path string, _secs double"
LABELS = "case_id string, " + ", ".join(f"{f} string" for f in dims.FIELD_WEIGHTS) + ", adjudication string"


def write_rows(rows: DataFrame, folder: str, private: bool = False) -> None:
    """One JSON line for each row, keys sorted, nothing under a leading underscore unless private; one file for each partition."""
    names = sorted(c for c in rows.columns if private or not c.startswith("_"))
    rows.select(*names).write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def read_rows(spark: SparkSession, path: str, private: bool = False) -> DataFrame:
    return spark.read.schema(DEV if private else ROW).json(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a CSV file with a header; columns are found by name."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path).select(*(F.col(x.split()[0]).cast("string").alias(x.split()[0]) for x in LABELS.split(", ")))


def complete(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """missing, doubled: how many of cases have no row, and how many have several."""
    n = rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    joined = cases.select("case_id").distinct().join(n, "case_id", "left")
    return joined.agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("doubled"))
