"""Recognised words. Recognisers are outside this engine; a source hands in what they read, as a table."""

from __future__ import annotations

import warnings
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.functions.match import NAMES

SCHEMA = "case_id string, page_index int, pass string, word_ord int, text string, conf double, block int, par int, line int, x double, y double, w double, h double"


class WordSource(Protocol):
    def words(self, spark: SparkSession, pass_name: str) -> DataFrame:
        """Words of one pass, as SCHEMA, confidence from 0 to 1."""


class TableWords:
    """Words from a table whose confidences are percentages; those under `least` and blank ones are left out."""

    def __init__(self, table: DataFrame, least: float = 30.0):
        self.table, self.least = table, least

    def words(self, spark: SparkSession, pass_name: str) -> DataFrame:
        own = self.table.filter((F.col("pass") == pass_name) & (F.col("conf") >= self.least) & (F.trim("text") != ""))
        return own.withColumn("conf", F.col("conf") / 100)


class NoWords:
    """A recogniser that is not there: no words, and one warning."""

    def __init__(self, name: str):
        self.name, self.said = name, False

    def words(self, spark: SparkSession, pass_name: str) -> DataFrame:
        if not self.said:
            warnings.warn(f"recogniser {self.name} is not available; its pass is empty", stacklevel=2)
            self.said = True
        return spark.createDataFrame([], SCHEMA)


def pooled(spark: SparkSession, sources: list[tuple[WordSource, str, float]]) -> DataFrame:
    """Words of several passes with pass_ord, each pass's confidences scaled by its factor."""
    out = None
    for i, (source, name, factor) in enumerate(sources):
        own = source.words(spark, name).withColumns({"conf": F.col("conf") * factor, "pass_ord": F.lit(i)})
        out = own if out is None else out.unionByName(own)
    return out


def dictionary() -> list[str]:
    """Words and phrases' words that a recogniser may be biased to, in the order of the vocabularies, each once."""
    entries = [*dims.SPECIES, *dims.WORLDS, *dims.VISAS, *dims.PURPOSES, *dims.FEES, *dims.FLAGS, *(x for x, _ in dims.ANCHORS), *NAMES]
    return list(dict.fromkeys(w for e in entries for w in e.split(" ")))
