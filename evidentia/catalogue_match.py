"""Queries of repairs and matches of garbled text."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import carriers, dims
from evidentia.carriers import mib, padded, plain, read
from evidentia.catalogue import query
from evidentia.functions import fuzzy
from evidentia.functions import match as M
from evidentia.functions import text as T
from evidentia.operators import pages as G

_GARBLED = f"""SELECT case_id, cand_ord, fld, value, CASE cand_ord % 7 WHEN 0 THEN value WHEN 1 THEN translate(value, '015', 'OlS') WHEN 2 THEN concat('  ', value, ' ') WHEN 3 THEN replace(value, '-', ' ')
  WHEN 4 THEN concat(value, ' COPY |') WHEN 5 THEN concat('x ', value, '7') ELSE substr(value, 2) END AS raw FROM ({carriers.CANDIDATES}) WHERE value IS NOT NULL"""


def garbled(spark, sf_dir, fld=None):
    out = read(spark, sf_dir, _GARBLED)
    return out.filter(F.col("fld") == fld) if fld else out


_TR = f"translate({{}}, '{dims.DIGIT_FROM}', '{dims.DIGIT_TO}')"


def _after(x: str, prefix: str) -> str:
    return f"CASE WHEN instr(upper({x}), '{prefix}') > 0 THEN substr({x}, 1, instr(upper({x}), '{prefix}') + 2) || " + _TR.format(f"substr({x}, instr(upper({x}), '{prefix}') + 3)") + " ELSE " + _TR.format(x) + " END"


@query(f"""WITH g AS (SELECT *, trim(raw) AS t FROM ({plain(_GARBLED)}) WHERE fld = 'sponsor_id'), m AS (SELECT *, regexp_extract(t, 'SPN\\s*[-–—._:]?\\s*([0-9]{{4}})([^0-9]|$)', 1) AS a, regexp_extract({_after('t', 'SPN')}, 'SPN\\s*[-–—._:]?\\s*([0-9]{{4}})([^0-9]|$)', 1) AS b FROM g)
SELECT case_id, cand_ord, raw, 'SPN-' || coalesce(nullif(a, ''), nullif(b, '')) AS repaired FROM m""")
def sponsor_repair(spark, sf_dir):
    return garbled(spark, sf_dir, "sponsor_id").select("case_id", "cand_ord", "raw", T.repair_sponsor_id(F.col("raw")).alias("repaired"))


_CASE_RAW = "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN " + mib("o_orderkey") + " WHEN 1 THEN concat('mib MIB ', translate(" + padded("o_orderkey", 6) + ", '01', 'OI')) WHEN 2 THEN concat('MIB:', cast(o_orderkey AS VARCHAR(9))) WHEN 3 THEN concat('Packet MIB', " + padded("o_orderkey", 6) + ", ' x') ELSE concat('M1B-', " + padded("o_orderkey", 6) + ") END AS raw FROM {orders}"


@query(f"""WITH m AS (SELECT *, regexp_extract(raw, 'MIB\\s*[-–—._:]?\\s*([0-9]{{6}})([^0-9]|$)', 1) AS a, regexp_extract({_after('raw', 'MIB')}, 'MIB\\s*[-–—._:]?\\s*([0-9]{{6}})([^0-9]|$)', 1) AS b FROM ({plain(_CASE_RAW)}))
SELECT o_orderkey, raw, 'MIB-' || coalesce(nullif(a, ''), nullif(b, '')) AS repaired FROM m""")
def case_id_repair(spark, sf_dir):
    return read(spark, sf_dir, _CASE_RAW).select("o_orderkey", "raw", T.repair_case_id(F.col("raw")).alias("repaired"))


_DAY_RAW = "SELECT o_orderkey, concat(CASE o_custkey % 6 WHEN 0 THEN '2025' WHEN 1 THEN '2O26' WHEN 2 THEN '2028' WHEN 3 THEN '2015' WHEN 4 THEN '2023' ELSE '2026' END, CASE o_orderkey % 3 WHEN 0 THEN '-' WHEN 1 THEN ' / ' ELSE '.' END, lpad(cast(o_orderkey % 14 AS VARCHAR(2)), 2, '0'), '-', lpad(cast(o_custkey % 32 AS VARCHAR(2)), 2, '0')) AS raw FROM {orders}"
_DP = r"(20[0-9]{2})\s*[-–—._/]\s*([0-9]{2})\s*[-–—._/]\s*([0-9]{2})"


@query(f"""WITH r AS (SELECT *, CASE WHEN regexp_matches(raw, '{_DP}') THEN raw ELSE {_TR.format('raw')} END AS t FROM ({plain(_DAY_RAW)})), y AS (SELECT *, regexp_extract(t, '{_DP}', 1) AS y, regexp_extract(t, '{_DP}', 2) AS m, regexp_extract(t, '{_DP}', 3) AS d FROM r),
z AS (SELECT *, CASE WHEN y IN ('2025', '2026') THEN y WHEN y IN ('2027', '2028', '2029') THEN '2026' WHEN y SIMILAR TO '20.5' THEN '2025' WHEN y SIMILAR TO '20.6' THEN '2026' END AS yy FROM y)
SELECT o_orderkey, raw, strftime(try_cast(yy || '-' || m || '-' || d AS DATE), '%Y-%m-%d') AS repaired FROM z""")
def date_repair(spark, sf_dir):
    return read(spark, sf_dir, _DAY_RAW).select("o_orderkey", "raw", T.repair_date(F.col("raw")).alias("repaired"))


@query(r"SELECT case_id, cand_ord, raw, trim(regexp_replace(trim(raw), '(?:\s*[|\[\](){}~™—–-]*\s*(?:SCAN IMAGE|PASSPORT IMAGE|REGISTRY IMAGE|MIB EYES ONLY|COPY ARTIFACT|CASEWORK|COPY|FILED|ARCHIVE|MIB INTAKE)\s*[|\[\](){}~™.—–-]*\s*)+$', '')) AS bare FROM (" + plain(_GARBLED) + ")")
def caption_strip(spark, sf_dir):
    return garbled(spark, sf_dir).select("case_id", "cand_ord", "raw", T.strip_captions(F.col("raw")).alias("bare"))


@query(r"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(t, '\s+'), lambda w: NOT (lower(w) IN ('packet', 'page', 'synthetic', 'hiring', 'challenge', 'document', '/', '') OR regexp_matches(w, '(?i)^mib[-.:]?[0-9]{6}$'))), ' ') AS bare
FROM (SELECT doc_id, concat(text, ' Packet MIB-000', 100 + doc_id % 900, ' / page 2 MIB-000001 synthetic x') AS t0, regexp_replace(concat(text, ' Packet MIB-000', 100 + doc_id % 900, ' / page 2 MIB-000001 synthetic x'), '(?i)packet\s+mib[-\s.:]*[0-9]{6}\s*/?\s*page(\s+[0-9]+(\s+of\s+[0-9]+)?)?|synthetic\s+hiring\s+challenge\s+document', ' ', 'g') AS t FROM documents)""")
def footer_strip(spark, sf_dir):
    """The page footer taken off each whole document, to which one is added."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" Packet MIB-000"), (100 + F.col("doc_id") % 900).cast("string"), F.lit(" / page 2 MIB-000001 synthetic x"))
    return docs.select("doc_id", T.strip_footer(text).alias("bare"))


_CORR = "SELECT event_id, concat('Manual Correction: ', CASE event_id % 5 WHEN 0 THEN 'home world' WHEN 1 THEN 'the visa' WHEN 2 THEN 'Sponsor id' WHEN 3 THEN 'nothing' ELSE 'arrival of species' END, ' is ', event_type, '.') AS text FROM {events}"


@query(f"SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'home_world' WHEN 1 THEN 'visa_class' WHEN 2 THEN 'sponsor_id' ELSE 'species_code' END AS fld, regexp_extract(text, ' is (.*)[.]$', 1) AS value FROM ({plain(_CORR)}) WHERE event_id % 5 <> 3")
def correction_parse(spark, sf_dir):
    out = read(spark, sf_dir, _CORR).select("event_id", T.parse_correction(F.col("text")).alias("c"))
    return out.filter("c IS NOT NULL").select("event_id", "c.fld", "c.value")


#: Weighted edit distance in DuckDB: a row of the table for each letter, each cell from the one before it.
_CHEAP = "|" + "|".join(sorted({a + b for g in dims.CONFUSIONS for a in g for b in g if a != b and "|" not in a + b})).replace("'", "''") + "|"


def _indel(c: str) -> str:
    return f"CASE WHEN contains('{dims.CHEAP_INDEL.replace(chr(39), chr(39) * 2)}', {c}) THEN 0.35::DOUBLE ELSE 1.0::DOUBLE END"


def distance_sql(pairs: str) -> str:
    """Common table expressions `dist` (a, b, d) for the texts of the expression pairs (a, b)."""
    sub = f"CASE WHEN lower(a[i]) = lower(b[j[1]::INT]) THEN 0.0::DOUBLE WHEN (lower(a[i]) <> '|' AND lower(b[j[1]::INT]) <> '|' AND contains('{_CHEAP}', '|' || lower(a[i]) || lower(b[j[1]::INT]) || '|')) OR (lower(a[i]) = '|' AND contains('1il!', lower(b[j[1]::INT]))) OR (lower(b[j[1]::INT]) = '|' AND contains('1il!', lower(a[i]))) THEN 0.2::DOUBLE ELSE 1.0::DOUBLE END"
    step = f"list_reduce(list_transform(range(1, length(b) + 1), lambda k: [k::DOUBLE]), lambda acc, j: list_append(acc, least(row[j[1]::INT + 1] + {_indel('a[i]')}, acc[len(acc)] + {_indel('b[j[1]::INT]')}, row[j[1]::INT] + {sub})), [row[1] + {_indel('a[i]')}])"
    return f"""pr AS ({pairs}), dp(a, b, i, row) AS (SELECT a, b, 1, list_transform(range(0, length(b) + 1), lambda k: k::DOUBLE) FROM pr UNION ALL SELECT a, b, i + 1, {step} FROM dp WHERE i <= length(a)),
dist AS (SELECT a, b, CASE WHEN a = b THEN 0.0::DOUBLE ELSE row[length(b) + 1] END AS d FROM dp WHERE i = length(a) + 1)"""


@query(f"""WITH RECURSIVE w AS (SELECT DISTINCT trim(raw) AS a FROM ({plain(_GARBLED)}) WHERE fld = 'home_world' AND trim(raw) <> ''), v AS (SELECT unnest([{dims.quoted(dims.WORLDS)}]) AS b), {distance_sql('SELECT a, b FROM w, v')}
SELECT a, b, round(d, 9) AS distance FROM dist""")
def weighted_distances(spark, sf_dir):
    """Garbled worlds against the vocabulary, each distinct pair once."""
    raws = garbled(spark, sf_dir, "home_world").select(F.trim("raw").alias("a")).filter("a <> ''").distinct()
    pairs = raws.select("a", F.explode(F.array(*map(F.lit, dims.WORLDS))).alias("b"))
    return pairs.select("a", "b", F.round(fuzzy.weighted_distance("a", "b"), 9).alias("distance"))


@query(f"""WITH RECURSIVE g AS (SELECT * FROM ({plain(_GARBLED)}) WHERE fld = 'home_world'), w AS (SELECT DISTINCT trim(raw) AS a FROM g WHERE trim(raw) <> ''), v AS (SELECT unnest([{dims.quoted(dims.WORLDS)}]) AS b), {distance_sql('SELECT a, b FROM w, v')},
n AS (SELECT a, b, d / greatest(length(a), length(b)) AS d FROM dist), r AS (SELECT *, row_number() OVER o AS rn, lead(d) OVER o AS nx FROM n WINDOW o AS (PARTITION BY a ORDER BY d, b)),
m AS (SELECT a, b FROM r WHERE rn = 1 AND d <= 0.30 AND (d = 0 OR nx - d >= 0.08)) SELECT case_id, cand_ord, raw, m.b AS world FROM g LEFT JOIN m ON m.a = trim(raw)""")
def vocab_match_margin(spark, sf_dir):
    """The nearest world of garbled values, with a cap and a margin; no second look with fused letters."""
    plain_match = M.text_udf(lambda x: M.nearest(x, dims.WORLDS, 0.30, fused=False))
    return M.of_distinct(garbled(spark, sf_dir, "home_world"), "raw", "world", plain_match(F.col("raw"))).select("case_id", "cand_ord", "raw", "world")


_FUSE = "SELECT event_id, replace(replace(CASE event_id % 4 WHEN 0 THEN 'cultural exchange' WHEN 1 THEN 'diplomatic' WHEN 2 THEN 'medical consult' ELSE 'reactor maintenance' END, 'm', 'rn'), 'd', 'cl') AS raw FROM {events}"


@query()
def fusion_rematch(spark, sf_dir):
    return M.of_distinct(read(spark, sf_dir, _FUSE), "raw", "purpose", M.match_column(F.col("raw"), "declared_purpose"))


@query()
def field_correction(spark, sf_dir):
    """Every field's raw value, without captions, matched or repaired in its field's own way."""
    out = garbled(spark, sf_dir).withColumn("bare", T.strip_captions(F.col("raw")))
    distinct = out.select("fld", "bare").distinct()
    own = {f: M.match_column(F.col("bare"), f) for f in ("species_code", "home_world", "visa_class", "declared_purpose")}
    own |= {"sponsor_id": T.repair_sponsor_id(F.col("bare")), "arrival_date": T.repair_date(F.col("bare")), "applicant_name": M.text_udf(M.names)(F.col("bare"))}
    parts = [distinct.filter(F.col("fld") == f).select("fld", "bare", c.alias("corrected")) for f, c in own.items()]
    fixed = parts[0]
    for p in parts[1:]:
        fixed = fixed.unionByName(p)
    return out.join(fixed, ["fld", "bare"], "left").select("case_id", "cand_ord", "fld", "raw", "corrected")


@query()
def name_correct(spark, sf_dir):
    return M.of_distinct(garbled(spark, sf_dir, "applicant_name"), "raw", "name", M.text_udf(M.names)(F.col("raw"))).select("case_id", "cand_ord", "raw", "name")


@query()
def name_joint_decode(spark, sf_dir):
    return M.of_distinct(garbled(spark, sf_dir, "applicant_name"), "raw", "name", M.text_udf(M.joint_names)(F.col("raw"))).select("case_id", "cand_ord", "raw", "name")


_LABELLED = f"""SELECT case_id, cand_ord, fld, concat(CASE fld {' '.join(f"WHEN '{f}' THEN '{next(x for x, y in dims.ANCHORS if y == f)}'" for f in carriers.VALUES)} END, CASE WHEN cand_ord % 6 = 0 THEN ' ' WHEN cand_ord % 9 = 1 THEN ':' ELSE ': ' END, value) AS text0 FROM ({carriers.CANDIDATES}) WHERE value IS NOT NULL"""
_LABELLED = f"SELECT case_id, cand_ord, fld, CASE WHEN cand_ord % 9 = 1 THEN replace(text0, ' ', '') WHEN cand_ord % 4 = 0 THEN translate(text0, 'oiS', '0l5') ELSE text0 END AS text FROM ({_LABELLED})"


@query()
def anchor_match(spark, sf_dir):
    """Lines "Label: value", some garbled, without colon, or without spaces."""
    return G.anchored(read(spark, sf_dir, _LABELLED)).select("case_id", "cand_ord", "text", "label", "value")


_HEAD = "SELECT 'MIB-000000' AS case_id, part AS page_index, k AS line_ord, CASE WHEN k = 1 THEN CASE part % 4 WHEN 0 THEN '| MIB Fee Receipt' WHEN 1 THEN 'FORM J-2080: Work Authorization Intake.' WHEN 2 THEN 'Planetary Reg1stry Extract MIB-000001' ELSE 'nothing to see here' END ELSE concat('line ', cast(k AS VARCHAR(9))) END AS text"


@query()
def doc_header_types(spark, sf_dir):
    lines = read(spark, sf_dir, f"{_HEAD} FROM (SELECT p_partkey AS part FROM {{part}}) LATERAL VIEW explode(array(0, 1, 2)) x AS k")
    return G.header_types(lines).select("page_index", "doc_type", "tier_x10")


_FLAG_TEXT = f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'n0ne.' WHEN 2 THEN f1 WHEN 3 THEN concat(f1, ', ', f2) WHEN 4 THEN substr(f1, 1, 8) ELSE 'unreadab' END AS raw
FROM (SELECT o_orderkey, {carriers._pick('o_custkey % 8', dims.FLAGS)} AS f1, {carriers._pick('(o_custkey + 5) % 8', dims.FLAGS)} AS f2 FROM {{orders}})"""


@query()
def flags_parse(spark, sf_dir):
    """Flags of "Observed flags" values, also cut short ones."""
    lines = read(spark, sf_dir, _FLAG_TEXT)
    parsed = M.text_udf(lambda x: ["|".join(found) if ok else None for found, ok in M.flag_reads(x, True)])(F.col("raw"))
    return M.of_distinct(lines, "raw", "flags", parsed)


@query()
def partial_ratio_phrase(spark, sf_dir):
    """Labels of garbled "FINDING: LABEL" lines, and abstentions."""
    raw = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN '| F1ND1NG: DEN1ED.' WHEN 1 THEN 'FINDNG: APPROVFD x' WHEN 2 THEN '| FINDING: NEEDS 7. | |' WHEN 3 THEN 'Finding: NEEDS_REVIEW' WHEN 4 THEN 'DENIED' ELSE event_type END AS text FROM {events}"
    return M.of_distinct(read(spark, sf_dir, raw), "text", "label", M.text_udf(M.phrases)(F.col("text")))


@query()
def reason_templates(spark, sf_dir):
    """Reason sentences that are near copies of one template, and the label that it alone may give."""
    raw = f"SELECT event_id, translate({carriers._pick('event_id % 13', dims.REASONS)}, CASE WHEN event_id % 3 = 0 THEN 'eo' ELSE '' END, CASE WHEN event_id % 3 = 0 THEN 'c0' ELSE '' END) AS text FROM {{events}}"
    found = M.of_distinct(read(spark, sf_dir, raw), "text", "template", M.text_udf(M.reasons)(F.col("text")))
    label = F.element_at(F.create_map(*(F.lit(x) for kv in dims.REASON_LABELS.items() for x in kv)), F.col("template"))
    return found.withColumn("label", label)


_BOUND_A = "SELECT DISTINCT upper(p_name) AS a FROM {part}"


@query(f"""WITH a AS ({plain(_BOUND_A)}), t AS (SELECT unnest([{dims.quoted(t.upper() for t in dims.REASONS)}]) AS b), c AS (SELECT a, b, list_sum(list_transform(list_distinct(string_split(a, '')), lambda x: least(length(a) - length(replace(a, x, '')), length(b) - length(replace(b, x, ''))))) AS n FROM a, t)
SELECT a, b, round(CASE WHEN n > 0 THEN 200.0 * n / (least(length(a), length(b)) + n) ELSE 0 END, 9)::DOUBLE AS bound FROM c""")
def partial_ratio_bound(spark, sf_dir):
    names = read(spark, sf_dir, _BOUND_A).select("a", F.explode(F.array(*(F.lit(t.upper()) for t in dims.REASONS))).alias("b"))
    return names.select("a", "b", F.round(fuzzy.ratio_bound_column(F.col("a"), F.col("b")), 9).alias("bound"))
