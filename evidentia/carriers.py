"""Evidence derived from the supplied tables, in SQL that Spark and DuckDB both read.

A packet is eight consecutive order keys. `{name}` stands for a supplied table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidentia import dims

VALUES = {
    "applicant_name": ("Aririx Ixozarn", "Miradane Luvoss", "Nexkesh Oriul", "Solmora Tekix", "Veenax"),
    "species_code": dims.SPECIES[:5],
    "home_world": ("Barnard-c", "Eris Relay", "Wolf-1061c", "Luyten-b", "Proxima-b"),
    "visa_class": dims.VISAS,
    "sponsor_id": ("SPN-0007", "SPN-1234", "SPN-4040", "SPN-5809", "SPN-8468"),
    "arrival_date": ("2025-11-03", "2026-01-10", "2026-04-14", "2026-05-04", "2026-06-30"),
    "declared_purpose": dims.PURPOSES[:5],
}
_FIELD_BY_PART = ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "fee_status")


def padded(key: str, digits: int) -> str:
    """A whole number as text of at least so many digits; longer ones stay whole."""
    text = f"cast({key} AS VARCHAR(20))"
    return f"concat(repeat('0', cast(greatest(0, {digits} - length({text})) AS INT)), {text})"


def mib(key: str) -> str:
    return f"concat('MIB-', {padded(key, 6)})"


def case_of(key: str) -> str:
    """The packet of a key."""
    return mib(f"({key} - {key} % 8)")


def _pick(column: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
    return f"CASE {column} {whens} END"


_LINES = f"""SELECT {case_of('l_orderkey')} AS case_id,
  row_number() OVER (PARTITION BY l_orderkey - l_orderkey % 8 ORDER BY l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, abs(l_discount), abs(l_tax), l_returnflag, l_linestatus, l_shipdate) AS cand_ord,
  l_linenumber - 1 AS page_index, {_pick('l_partkey % 8', _FIELD_BY_PART)} AS fld,
  CASE l_linenumber WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 50 WHEN 5 THEN 25 WHEN 6 THEN 15 ELSE 10 END AS tier_x10,
  CASE WHEN l_returnflag = 'R' THEN 'digital' ELSE 'ocr' END AS source,
  30 + 5 * (l_suppkey % 14) AS conf_bp, (l_partkey + l_suppkey) % 5 AS value_ix,
  l_partkey, l_suppkey, l_quantity, l_extendedprice FROM {{lineitem}}"""

CANDIDATES = f"""SELECT case_id, cand_ord, page_index, fld, tier_x10, source, conf_bp,
  CASE fld {' '.join(f"WHEN '{f}' THEN {_pick('value_ix', v)}" for f, v in VALUES.items())} END AS value
FROM ({_LINES}) WHERE fld <> 'fee_status'"""

FEE_ROWS = f"""SELECT case_id, cand_ord, page_index, tier_x10, source, conf_bp,
  {_pick("(l_partkey - l_partkey % 8) / 8 % 5", (*dims.FEES, None))} AS status,
  {_pick("l_suppkey % 4", ("$809.00", "$0.00", "$5oO.00", None))} AS amount_raw,
  {_pick("cast(l_quantity AS BIGINT) % 3", ("DIP-WAIVER", "N/A", None))} AS waiver
FROM ({_LINES}) WHERE fld = 'fee_status'"""

FLAG_CANDIDATES = f"""SELECT {case_of('o_orderkey')} AS case_id, o_orderkey AS flag_ord,
  CASE WHEN o_orderkey % 9 < 6 THEN '' WHEN o_orderkey % 9 < 8 THEN {_pick('o_custkey % 8', dims.FLAGS)}
       ELSE concat({_pick('o_custkey % 8', dims.FLAGS)}, ',', {_pick('(o_custkey + 3) % 8', dims.FLAGS)}) END AS flags_text,
  o_custkey % 7 < 6 AS parsed_ok, CASE WHEN o_orderstatus = 'P' THEN 'digital' ELSE 'ocr' END AS source,
  30 + 5 * (o_custkey % 14) AS conf_bp FROM {{orders}}"""

FINDINGS = f"""SELECT {case_of('event_id')} AS case_id, event_id AS find_ord,
  CASE WHEN event_id % 3 = 0 THEN {_pick('event_id % 7', dims.REASON_LABELS.values())}
       WHEN event_type = 'click' THEN 'APPROVED' WHEN event_type = 'error' THEN 'DENIED' ELSE 'NEEDS_REVIEW' END AS label,
  event_id % 3 = 0 AS template_only, CASE WHEN event_id % 3 = 0 THEN {_pick('event_id % 7', dims.REASON_LABELS)} END AS template,
  CASE WHEN event_id % 2 = 0 THEN 'digital' ELSE 'ocr' END AS source, 30 + 5 * (user_id % 14) AS conf_bp
FROM {{events}} WHERE event_type IN ('click', 'error', 'view')"""

CASES = f"SELECT DISTINCT {case_of('o_orderkey')} AS case_id FROM {{orders}}"

ALL = {"candidates": CANDIDATES, "fee_rows": FEE_ROWS, "flag_candidates": FLAG_CANDIDATES, "findings": FINDINGS, "cases": CASES}
_TABLES = ("lineitem", "orders", "events", "documents", "labels", "embeddings", "pages", "part", "customer", "nation", "supplier")


def tables_of(sql: str) -> list[str]:
    return [t for t in _TABLES if "{" + t + "}" in sql]


def read(spark: SparkSession, sf_dir: str, sql: str, **more: DataFrame) -> DataFrame:
    """The rows of carrier SQL over the tables of sf_dir."""
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(sql)}, **more)


def plain(sql: str) -> str:
    """The same SQL with the tables' own names, for the oracle."""
    for t in _TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql
