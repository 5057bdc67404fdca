"""A corpus in five stages: language, toxicity, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; docs has the columns of documents, and whatever further ones,
which pass through. Models are learnt from the labels and languages of sf_dir's tables, as in the operators' own queries;
a stage decides on all of docs. Null texts count as empty. Rows whose id is null or repeated are decided each by itself, but
for near copies, where rows of one id are one document.

* language: documents whose language can't be told (no letter, or less than LEAST_SURE sure) go.
* toxicity: documents that score 0.5 or more go.
* near_copies: of each component by shingles of five words at similarity 0.8, the document of the smallest id stays.
* secrets: secrets in texts are masked; no document goes.
* packing: the pieces of the documents left, with their sequences; the token ids' checksums go along.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import language_id, near_dedup, packing, secret_scan, toxicity
from evidentia.llm.arrow import remainder
from evidentia.plans.workspace import shared_root

#: Least posterior probability of a document's language.
LEAST_SURE = 0.4


def _judged(docs: DataFrame) -> DataFrame:
    """Whole rows beside their texts, so that no column of theirs meets a stage's own."""
    return docs.select(F.struct(*docs.columns).alias("whole"), "text")


def _rows(judged: DataFrame) -> DataFrame:
    return judged.select("whole.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(own.filter(remainder("doc_id", 3) != 1))
    said = language_id.predict(_judged(docs), model, ["whole"])
    return _rows(said.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SURE)))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet").filter(remainder("doc_id", 5) != 0) for t in ("documents", "labels"))
    scored = toxicity.predict(_judged(docs), toxicity.train(own, labels), ["whole"])
    return _rows(scored.filter("predicted = 0"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    gone = near_dedup.dedup(docs.select("doc_id", "text")).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return packing.query(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("language", language), ("toxicity", toxic), ("near_copies", near_copies), ("secrets", secrets), ("packing", pack)]

#: The models, minima and merges of the stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again for the next."""
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
