"""The queries of the evidence engine, each with its SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia import carriers, dims
from evidentia.operators import evidence as E
from evidentia.operators import policy as P
from evidentia.oracle import sql
from evidentia.plans.ship import ship

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL where SQL can express it."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        _QUERIES[f.__name__] = run
        if oracle:
            _SQL[f.__name__] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    from evidentia import catalogue_collect, catalogue_lines, catalogue_match, catalogue_measure, catalogue_rereads  # noqa: F401  they register theirs

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def carrier(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return carriers.read(spark, sf_dir, carriers.ALL[name])


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.reconcile(*(carrier(spark, sf_dir, n) for n in ("candidates", "fee_rows", "flag_candidates", "findings", "cases")))


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.decide(P.template_rescue(P.cascade(evidence(spark, sf_dir))), dims.path_stats(spark))


_ROW = ", ".join(["case_id", *dims.FIELDS, "risk_flags", "adjudication", "confidence"])


@query(sql(f"SELECT {_ROW} FROM row"))
def entry_case_decisions(spark, sf_dir):
    """Vote, cascade, choice and emission: one row for each packet."""
    return P.build_row(decided(spark, sf_dir))


@query(sql("SELECT case_id, fld, value, score, conf_bp, source FROM voted"))
def weighted_vote(spark, sf_dir):
    return E.vote(E.weighted(carrier(spark, sf_dir, "candidates").repartition("case_id")))


@query(sql("SELECT case_id, fld, value, conf_bp, source FROM corr"))
def correction_override(spark, sf_dir):
    return E.corrections(E.weighted(carrier(spark, sf_dir, "candidates")))


@query(sql("SELECT case_id, fld, value, score, conf_bp, source FROM cvoted"))
def digital_first_vote(spark, sf_dir):
    return E.vote(E.digital_first(E.weighted(carrier(spark, sf_dir, "candidates").repartition("case_id"))))


@query(sql("SELECT case_id, fld, value, conf_bp, known FROM named"))
def digital_name_choice(spark, sf_dir):
    """Each field's settled value; digital names that agree outdo the vote."""
    return E.settle(E.digital_first(E.weighted(carrier(spark, sf_dir, "candidates").repartition("case_id"))))


@query(sql("SELECT case_id, page_index, verdict, conf_bp, weight FROM feep"))
def fee_truth_table(spark, sf_dir):
    return E.fee_pages(carrier(spark, sf_dir, "fee_rows")).drop("first_ord")


@query(sql("SELECT case_id, value, score, conf_bp FROM fees"))
def fee_resolution(spark, sf_dir):
    return E.resolve_fee(carrier(spark, sf_dir, "fee_rows"))


@query(sql("SELECT case_id, array_to_string(flags, '|') AS flags, flags_known FROM flagu"))
def flags_union(spark, sf_dir):
    out = E.flags_union(carrier(spark, sf_dir, "flag_candidates"))
    return out.withColumn("flags", F.array_join("flags", "|"))


@query(sql("SELECT case_id, finding_label, finding_conf_bp, finding_conflict, template_label, template, template_conf_bp FROM findu"))
def finding_conflict(spark, sf_dir):
    return E.findings_of(carrier(spark, sf_dir, "findings"))


_WIDE = ", ".join([*(f"{f}_{k}" for f in dims.FIELDS for k in ("value", "known", "conf_bp")), "flags_known", "finding_label", "finding_conflict", "arrival_on_intake"])


@query(sql(f"SELECT case_id, {_WIDE}, array_to_string(flags, '|') AS flags FROM ev"))
def reconciled_evidence(spark, sf_dir):
    out = evidence(spark, sf_dir)
    return out.select("case_id", *_WIDE.split(", "), F.array_join("flags", "|").alias("flags"))


@query(sql("""SELECT case_id, concat_ws(',', CASE WHEN fee_status_value IS NULL THEN 'fee_status' END, CASE WHEN NOT flags_known THEN 'risk_flags' END,
  CASE WHEN NOT arrival_on_intake THEN 'arrival_date' END, CASE WHEN visa_class_value IS NULL THEN 'visa_class' END, CASE WHEN home_world_value IS NULL THEN 'home_world' END,
  CASE WHEN coalesce(visa_class_value, '') <> 'DIP-1' AND sponsor_id_value IS NULL THEN 'sponsor_id' END) AS unread FROM ev"""))
def underdetermined_inputs(spark, sf_dir):
    return P.unread_inputs(evidence(spark, sf_dir)).select("case_id", F.array_join("unread", ",").alias("unread"))


@query(sql("SELECT case_id, path0 AS path, label0 AS policy_label FROM labelled"))
def policy_cascade(spark, sf_dir):
    return P.cascade(evidence(spark, sf_dir)).select("case_id", "path", "policy_label")


@query(sql("SELECT path0 AS path, count(*) AS n FROM core GROUP BY path0"))
def policy_path_counts(spark, sf_dir):
    return P.cascade(evidence(spark, sf_dir)).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query(sql("SELECT case_id, path, policy_label FROM lab"))
def template_rescue(spark, sf_dir):
    return P.template_rescue(P.cascade(evidence(spark, sf_dir))).select("case_id", "path", "policy_label")


@query(sql("SELECT case_id, under AND NOT denies AS stamp_eligible FROM deny"))
def stamp_rescue_eligible(spark, sf_dir):
    return P.stamp_eligible(P.cascade(evidence(spark, sf_dir))).select("case_id", "stamp_eligible")


@query(sql("SELECT case_id, path, adjudication, round(confidence, 9) AS confidence FROM dec"))
def expected_value_decision(spark, sf_dir):
    return decided(spark, sf_dir).select("case_id", "path", "adjudication", F.round("confidence", 9).alias("confidence"))


@query(sql("SELECT case_id, adjudication, round(confidence, 9) AS confidence FROM dec"))
def rescore_replay(spark, sf_dir):
    """Decisions again from stored paths alone."""
    stored = decided(spark, sf_dir).select("case_id", "path")
    again = P.decide(stored.withColumn("policy_label", P.policy_label_of(F.col("path"))), dims.path_stats(spark))
    return again.select("case_id", "adjudication", F.round("confidence", 9).alias("confidence"))


@query(sql(f"SELECT {_ROW} FROM row WHERE adjudication = 'APPROVED'"))
def emission_guard(spark, sf_dir):
    return P.build_row(decided(spark, sf_dir)).filter("adjudication = 'APPROVED'")


_RAW = ", ".join(f"{f}_{k}" for f in dims.FIELDS for k in ("value", "known", "conf_bp"))


@query(sql("SELECT e.case_id, " + ", ".join(f"CASE WHEN e.{f}_known THEN e.{f}_value ELSE w.{f}_value END AS {f}_value, CASE WHEN e.{f}_known THEN e.{f}_conf_bp ELSE w.{f}_conf_bp END AS {f}_conf_bp, e.{f}_known OR w.{f}_known AS {f}_known" for f in dims.FIELDS) + " FROM ev e JOIN late w USING (case_id)",
           late="SELECT case_id, " + ", ".join(f"concat(coalesce({f}_value, ''), '*') AS {f}_value, {f}_conf_bp + 1 AS {f}_conf_bp, TRUE AS {f}_known" for f in dims.FIELDS) + " FROM ev"))
def restore_guard(spark, sf_dir):
    """A later pass that rewrites every field may only fill those that were not known."""
    before = evidence(spark, sf_dir)
    late = before.withColumns({k: v for f in dims.FIELDS for k, v in ((f"{f}_value", F.concat(F.coalesce(f"{f}_value", F.lit("")), F.lit("*"))), (f"{f}_conf_bp", F.col(f"{f}_conf_bp") + 1), (f"{f}_known", F.lit(True)))})
    return P.restore_guard(before, late).select("case_id", *_RAW.split(", "))


@query(sql("SELECT " + _ROW + " FROM row WHERE cast(substr(case_id, 5) AS BIGINT) % 56 <> 0 UNION ALL SELECT case_id, " + ", ".join(f"'{v}'" for v in dims.DEFAULTS.values()) + ", 'none', 'NEEDS_REVIEW', 0.35 FROM cases WHERE cast(substr(case_id, 5) AS BIGINT) % 56 = 0"))
def error_fallback(spark, sf_dir):
    """Packets whose processing failed (here every seventh) get the fallback row."""
    rows = P.build_row(decided(spark, sf_dir)).filter(F.expr("substr(case_id, 5)").cast("long") % 56 != 0)
    return P.fallback_rows(carrier(spark, sf_dir, "cases"), rows)


@query(sql("SELECT case_id FROM cases WHERE case_id NOT IN (SELECT case_id FROM find)"))
def pending_anti_join(spark, sf_dir):
    """Packets that are not finished yet."""
    return carrier(spark, sf_dir, "cases").join(carrier(spark, sf_dir, "findings"), "case_id", "left_anti")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def labels_semi_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars")
    return docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left_semi")
