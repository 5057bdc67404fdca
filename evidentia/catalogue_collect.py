"""Queries from lines to candidates and findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import carriers, dims
from evidentia.carriers import case_of, mib, padded, plain, read
from evidentia.catalogue import query
from evidentia.operators import collect as K

#: A packet's pages: an intake form, a fee receipt, a note and a slip, from a customer's numbers; some lines are garbled.
_NAMES, _WORLDS = carriers.VALUES["applicant_name"][:4], dims.WORLDS
_LINE = (
    "CASE k WHEN 0 THEN 'FORM I-8090: Extraterrestrial Work Authorization Intake' WHEN 1 THEN concat('Applicant: ', " + carriers._pick("c % 4", _NAMES) + ") WHEN 2 THEN concat('Home Wor1d: ', " + carriers._pick("c % 13", _WORLDS) + ")"
    " WHEN 3 THEN concat('SponsorID:SPN-', " + padded("c % 9999", 4) + ") WHEN 4 THEN concat('Arrival Date: 2026-0', cast(1 + c % 9 AS VARCHAR(1)), '-14') WHEN 5 THEN 'Manual correction: visa is MED-3.'"
    " WHEN 10 THEN 'MIB Fee Receipt' WHEN 11 THEN CASE WHEN c % 3 = 0 THEN '| Fec waived |' ELSE 'Fee Status: paid' END WHEN 12 THEN 'Amount: $809.00' WHEN 13 THEN 'Waiver Code: N/A'"
    " WHEN 20 THEN 'Manual Adjudicator Note' WHEN 21 THEN CASE c % 4 WHEN 0 THEN 'Finding: DENIED. Revoked sponsor: SPN-0007.' WHEN 1 THEN '| F1ND1NG: DEN1ED.' WHEN 2 THEN 'DENIED' ELSE 'Mandatory fee unpa1d.' END"
    " WHEN 22 THEN CASE WHEN c % 4 = 2 THEN 'Reason: Mandatory fee unpaid.' ELSE 'and more words' END WHEN 30 THEN 'FORM B-13: Biometric Scan Slip' WHEN 31 THEN 'Observed flags: memory_tamperinq' WHEN 32 THEN 'Species Match: TRIANGULAN' END"
)
_K = (0, 1, 2, 3, 4, 5, 10, 11, 12, 13, 20, 21, 22, 30, 31, 32)
PACKET_LINES = f"SELECT {mib('c')} AS case_id, cast((k - k % 10) / 10 AS INT) AS page_index, k % 10 AS line_ord, {_LINE} AS text, CASE WHEN c % 2 = 0 THEN 'digital' ELSE 'ocr' END AS source, 60 + k AS conf_bp, TRUE AS dark, TRUE AS tier1_ok FROM (SELECT c_custkey AS c, k FROM {{customer}} LATERAL VIEW explode(array({', '.join(map(str, _K))})) x AS k)"
_FOOT = f"SELECT {mib('c_custkey')} AS case_id, 0 AS page_index, concat('Packet ', {mib('c_custkey')}, ' / page 1') AS text FROM {{customer}}"


def _parts(spark, sf_dir):
    return K.Collected(read(spark, sf_dir, PACKET_LINES), read(spark, sf_dir, _FOOT))


@query()
def collected_candidates(spark, sf_dir):
    return _parts(spark, sf_dir).candidates().select("case_id", "page_index", "cand_ord", "fld", "raw", "value", "tier_x10", "source", "conf_bp")


@query()
def collected_flags(spark, sf_dir):
    return _parts(spark, sf_dir).flags().select("case_id", "page_index", F.array_join("flags", "|").alias("flags"), "parsed_ok", "tier_x10", "conf_bp")


@query(f"""SELECT {mib('c_custkey')} AS case_id, 2 AS page_index, 'DENIED' AS label, c_custkey % 4 = 3 AS template_only, CASE WHEN c_custkey % 4 = 3 THEN 'Mandatory fee unpaid.' END AS template,
  CASE WHEN c_custkey % 4 = 2 THEN 81 ELSE 81 END AS conf_bp FROM customer""")
def collected_findings(spark, sf_dir):
    """A printed finding, a garbled phrase, a stamp with a reason, and a reason alone, by customer."""
    return _parts(spark, sf_dir).findings().select("case_id", "page_index", "label", "template_only", "template", "conf_bp")


@query(f"SELECT {mib('c_custkey')} AS case_id, 'sponsor_id' AS fld, 'SPN-0007' AS value, 81 AS conf_bp FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT {mib('c_custkey')}, 'fee_status', 'unpaid', 81 FROM customer WHERE c_custkey % 4 = 2")
def reason_mining(spark, sf_dir):
    return K.mine_reasons(_parts(spark, sf_dir).findings())


@query(f"SELECT {mib('c_custkey')} AS case_id, k AS page_index, ['intake', 'fee_receipt', 'note', 'biometric'][k + 1] AS doc_type FROM customer, (SELECT unnest([0, 1, 2, 3]) AS k)")
def page_types(spark, sf_dir):
    return K.page_types(K.read_lines(read(spark, sf_dir, PACKET_LINES))).select("case_id", "page_index", "doc_type")


_PROBES = f"SELECT {case_of('o_custkey')} AS case_id, o_orderkey % 3 AS page_index, k AS probe_ord, (k * 3) % 4 AS k, o_orderkey AS word_ord, CASE (o_orderkey + k) % 5 WHEN 0 THEN 'Applicant' WHEN 1 THEN 'species' WHEN 2 THEN 'qwertz' WHEN 3 THEN 'Finding' ELSE 'ab' END AS text, CASE WHEN (o_custkey + k) % 4 = 0 THEN 0.4 ELSE 0.9 END AS conf FROM {{orders}} LATERAL VIEW explode(array(0, 1, 2, 3)) x AS k"


@query()
def rotation_choice(spark, sf_dir):
    return K.choose_rotation(read(spark, sf_dir, _PROBES), ["applicant", "species", "finding"])


_LONG = f"SELECT {case_of('doc_id')} AS case_id, doc_id AS page_index, length(text) AS n FROM {{documents}}"


@query(f"SELECT case_id, page_index FROM ({plain(_LONG)}) WHERE n < 100")
def nearly_empty_pages(spark, sf_dir):
    """Pages, here whole documents with line breaks as spaces, on which next to nothing was read."""
    lines = read(spark, sf_dir, f"SELECT {case_of('doc_id')} AS case_id, doc_id AS page_index, 0 AS line_ord, regexp_replace(text, '[ \\n]', '_') AS text, 90 AS conf_bp FROM {{documents}} WHERE text IS NOT NULL")
    return K.nearly_empty(lines)
