"""Packets as files, and their case ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions.text import FOOTER


def scan(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """path, stem, length (and content) of the folder's packets: PDF files whose stem is a case id. Their bytes are read only on demand."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "MIB-*.pdf").load(folder)
    stem = F.regexp_extract("path", r"([^/]+)\.pdf$", 1)
    named = files.withColumn("stem", stem).filter(F.col("stem").rlike("^MIB-[0-9]{6}$"))
    return named.select("path", "stem", "length", *(["content"] if content else []))


def case_ids(stems: DataFrame, spans: DataFrame) -> DataFrame:
    """stem and case_id: the stem if it is a case id, else the first page footer's, else the stem. spans: stem, page_index, text."""
    found = spans.withColumn("id", F.nullif(F.regexp_extract("text", FOOTER, 1), F.lit(""))).filter("id IS NOT NULL")
    first = found.groupBy("stem").agg(F.min(F.struct("page_index", "id")).alias("f"))
    joined = stems.select("stem").distinct().join(first, "stem", "left")
    return joined.select("stem", F.when(F.col("stem").rlike("^MIB-[0-9]{6}$"), F.col("stem")).otherwise(F.coalesce("f.id", "stem")).alias("case_id"))


def render_dpi(width_pt, height_pt, dpi: int = 288, most: float = 40e6):
    """The resolution at which a page of these points stays under `most` pixels, but 72 at least."""
    pixels = (width_pt * dpi / 72.0) * (height_pt * dpi / 72.0)
    return F.when(pixels <= most, F.lit(dpi)).otherwise(F.greatest(F.lit(72), (dpi * F.sqrt(most / pixels)).cast("int")))
