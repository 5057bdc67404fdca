"""Queries of second looks and of the laboratory."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.carriers import mib, plain, read
from evidentia.catalogue import decided, query
from evidentia.config import EngineConfig
from evidentia.operators import laboratory as L
from evidentia.operators import rereads as R

_TRACES = """SELECT p_partkey, transform(split(p_name, ''), c -> ascii(c)) AS chars, CASE p_size % 3 WHEN 0 THEN 'Times-Italic' WHEN 1 THEN 'Courier-OBLIQUE' END AS font,
  CASE WHEN p_size % 4 = 0 THEN array() ELSE array(0.5D) END AS color FROM {part}"""


@query("SELECT p_partkey, p_name AS text, p_size % 3 < 2 AS italic, p_size % 4 <> 0 AS coloured FROM part")
def span_projection(spark, sf_dir):
    return R.spans_of(read(spark, sf_dir, _TRACES)).select("p_partkey", "text", "italic", F.col("color").isNotNull().alias("coloured"))


_PAGES = "SELECT o_custkey AS case_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS page_index, o_orderkey FROM {orders}"


@query(f"SELECT * FROM ({plain(_PAGES)}) WHERE page_index < {dims.SYNTHESIS_PAGES}")
def page_cap(spark, sf_dir):
    return R.first_pages(read(spark, sf_dir, _PAGES), dims.SYNTHESIS_PAGES)


_SPANS = """SELECT l_orderkey AS case_id, l_linenumber AS page_index, l_partkey, CASE WHEN l_partkey % 5 = 0 THEN ' Packet MIB-000123 / page 2' WHEN l_partkey % 7 = 0 THEN '  ' ELSE 'span' END AS text,
  1.0 AS x0, l_quantity * 2 AS y0, 90.0 AS x1, l_quantity * 2 + 1 AS y1, l_suppkey % 11 + 2.0 AS size, 1.0 AS opacity, 0 AS render_type, 100.0 AS page_w, 200.0 AS page_h FROM {lineitem}"""
_IMAGES = "SELECT l_orderkey AS case_id, l_linenumber AS page_index, l_extendedprice AS img_area, 60000.0 AS page_area FROM {lineitem} WHERE l_suppkey % 3 > 0"


@query(f"""WITH s AS ({plain(_SPANS)}), k AS (SELECT case_id, page_index, max(img_area / page_area) >= 0.5 AS scan FROM ({plain(_IMAGES)}) GROUP BY 1, 2)
SELECT case_id, page_index, CASE WHEN coalesce(scan, false) THEN 'scan' ELSE 'digital' END AS kind, count(*) AS n,
  count(*) FILTER (trim(text) <> '' AND size >= 6 AND (NOT coalesce(scan, false) OR l_partkey % 5 = 0)) AS trusted FROM s LEFT JOIN k USING (case_id, page_index) GROUP BY 1, 2, 3""")
def page_load(spark, sf_dir):
    """What is trusted on digital and scanned pages."""
    spans = read(spark, sf_dir, _SPANS).withColumns({"color": F.lit(None).cast("array<double>"), "italic": F.lit(False)})
    typed, _ = R.load_pages(spans, read(spark, sf_dir, _IMAGES))
    return typed.groupBy("case_id", "page_index", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("trusted").alias("trusted"))


_WORDS = """SELECT user_id AS case_id, event_id % 50 AS page_index, CASE event_id % 7 WHEN 0 THEN 'Sponsor:' WHEN 1 THEN 'Page' WHEN 2 THEN 'mib-000123' WHEN 3 THEN 'receipted' WHEN 4 THEN 'FEE-STATUS' ELSE event_type END AS text,
  event_id * 13 % 100 / 100.0 AS conf FROM {events}"""


@query(f"""SELECT case_id, page_index, count(*) FILTER (conf > 0.5 AND lower(text) NOT IN ({dims.quoted(dims.FOOTER_WORDS)}) AND NOT starts_with(upper(text), 'MIB-')) AS content,
  count(*) FILTER (conf > 0.5 AND regexp_matches(text, '{dims.TEMPLATE_WORD}')) >= 2 AS readable FROM ({plain(_WORDS)}) GROUP BY 1, 2""")
def readable_pages(spark, sf_dir):
    return R.readable(read(spark, sf_dir, _WORDS))


_KINDS = f"""SELECT {mib('o_custkey')} AS case_id, o_orderkey AS page_index, CASE WHEN o_orderkey % 3 = 0 THEN 'digital' ELSE 'scan' END AS kind,
  CASE o_custkey % 4 WHEN 0 THEN 'intake' WHEN 1 THEN 'attestation' WHEN 2 THEN 'receipt' END AS doc_type FROM {{orders}}"""
_RENDERED = f"SELECT {mib('o_custkey')} AS case_id, o_orderkey AS page_index FROM {{orders}} WHERE o_orderkey % 5 > 0"
_NAMED = f"SELECT {mib('o_custkey')} AS case_id, o_orderkey AS page_index, concat('Packet ', {mib('CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END')}, ' / page 1') AS text FROM {{orders}}"


@query(f"SELECT * FROM ({plain(_KINDS)}) WHERE kind = 'scan' AND doc_type IN ('intake', 'attestation') AND page_index % 5 > 0 AND page_index % 7 > 0")
def reread_pages(spark, sf_dir):
    """Own scanned pages of the wanted types."""
    return R.candidate_pages(*(read(spark, sf_dir, q) for q in (_KINDS, _RENDERED, _NAMED)), ("intake", "attestation"))


_VIEWED = """SELECT c_custkey, c_custkey % 3 = 0 AS upright, c_custkey % 4 AS best_rot, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey % 4 END AS probe_k, c_custkey % 2 = 0 AS probe_confident FROM {customer}"""


@query(f"""WITH v AS ({plain(_VIEWED)}), e AS (SELECT *, CASE WHEN best_rot = 0 THEN 1 ELSE best_rot END AS r FROM v),
k AS (SELECT c_custkey, NOT upright OR probe_k IS NOT NULL AS padded, CASE WHEN probe_k IS NOT NULL AND probe_confident THEN [probe_k] WHEN probe_k IS NOT NULL THEN [probe_k, (probe_k + 2) % 4]
  WHEN upright THEN [0] ELSE list_sort([r, (r + 2) % 4]) END AS ks FROM e)
SELECT c_custkey, padded, i - 1 AS view_ord, ks[i] AS k FROM (SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM k)""")
def escalation_turns(spark, sf_dir):
    config = EngineConfig(escalation_views=True, rotation_probe=True)
    return R.escalation_views(read(spark, sf_dir, _VIEWED), config).select("c_custkey", "padded", "view_ord", "k")


_HITS = "SELECT user_id AS case_id, event_id % 3 AS page_index, event_type AS fld, event_id % 40 AS row, event_id AS hit_ord, event_id * 7 % 41 AS conf_bp, event_id % 680 AS x, event_id % 900 AS y FROM {events}"
_ROWS = "SELECT {k}, row, first(struct_pack(c := conf_bp, x := x, y := y) ORDER BY conf_bp DESC, hit_ord) AS t, min(hit_ord) AS first_ord FROM ({h}) GROUP BY {k}, row"


def _strip_sql(keys: str, ties: str, most: int) -> str:
    rows = _ROWS.format(k=keys, h=plain(_HITS))
    return f"SELECT {keys}, row, t.c AS conf_bp, t.x AS x, t.y AS y, rank FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY t.c DESC, {ties}) AS rank FROM ({rows})) WHERE rank <= {most}"


@query(_strip_sql("case_id, page_index", "first_ord", dims.PAGE_STRIPS))
def page_strip_choice(spark, sf_dir):
    return R.page_strips(read(spark, sf_dir, _HITS))


@query(_strip_sql("case_id, page_index, fld", "t.y DESC, t.x DESC, first_ord", dims.FIELD_STRIPS))
def field_strip_choice(spark, sf_dir):
    return R.field_strips(read(spark, sf_dir, _HITS))


@query("""WITH e AS (SELECT vec_id, f, c, embedding[f * 4 + c + 1]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(0, 16)) AS f), (SELECT unnest(range(0, 4)) AS c)),
t AS (SELECT vec_id, f, first(c ORDER BY v DESC, c) AS id, exp(max(v)) / sum(exp(v)) AS p FROM e GROUP BY 1, 2), k AS (SELECT *, lag(id) OVER (PARTITION BY vec_id ORDER BY f) AS prev FROM t),
r AS (SELECT vec_id, string_agg(substr('abc', id, 1), '' ORDER BY f) AS text, avg(p) AS conf FROM k WHERE id <> 0 AND id IS DISTINCT FROM prev GROUP BY 1)
SELECT vec_id, coalesce(text, '') AS text, round(coalesce(conf, 0), 6) AS conf FROM (SELECT DISTINCT vec_id FROM embeddings) LEFT JOIN r USING (vec_id)""")
def greedy_ctc(spark, sf_dir):
    """Embeddings as scores of sixteen frames of four classes, read by their likeliest classes."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    frames = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice(F.col("embedding").cast("array<double>"), F.lit(1) + i * 4, F.lit(4)))
    return e.select("vec_id", R.greedy_decode(frames, "abc").alias("r")).select("vec_id", "r.text", F.round("r.conf", 6).alias("conf"))


_CELLS = "SELECT user_id AS case_id, event_id % 4 AS page_index, event_id % 9 AS row, event_id * 17 % 600 AS x, event_id % 11 AS y, concat(event_type, cast(event_id AS VARCHAR(20))) AS text, event_id % 100 / 100.0 AS conf FROM {events}"


@query(f"SELECT case_id, page_index, row AS line_ord, string_agg(text, ' ' ORDER BY x, y, text) AS text, round(avg(conf::DOUBLE) * {dims.READER_SCALE}, 6) AS conf FROM ({plain(_CELLS)}) GROUP BY 1, 2, 3")
def row_merge(spark, sf_dir):
    cells = read(spark, sf_dir, _CELLS).withColumn("conf", F.col("conf").cast("double"))
    return R.merged_rows(cells).withColumn("conf", F.round("conf", 6))


@query()
def second_reader_lines(spark, sf_dir):
    """Boxes of a second reader as lines: one box for each place, no sponsors."""
    boxes = read(spark, sf_dir, """SELECT l_orderkey AS case_id, l_linenumber AS page_index, l_partkey AS box_ord, l_suppkey % 600 AS x0, cast(l_quantity AS INT) * 9 AS y0, l_suppkey % 600 + 80 AS x1,
      cast(l_quantity AS INT) * 9 + 14 AS y1, CASE WHEN l_partkey % 9 = 0 THEN 'SPN 1234' WHEN l_partkey % 11 = 0 THEN ' ' ELSE concat('w', cast(l_partkey AS VARCHAR(12))) END AS text, l_tax * 10 AS conf FROM {lineitem}""")
    return R.reader_lines(boxes)


_SPONSOR_READS = """SELECT l_orderkey AS case_id, l_linenumber AS page_index, concat(CASE l_partkey % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'otsu' ELSE 'ppocr' END, '-', cast(l_suppkey % 2 AS VARCHAR(2))) AS view,
  CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN 'SPN-0007' ELSE 'SPN-4040' END AS value, CASE WHEN l_partkey % 4 = 0 THEN 'Sponsor ID: SPN-OOO7' ELSE 'Sponsor ID: SPN-0007' END AS raw, 40 + l_partkey % 50 AS conf_bp FROM {lineitem}"""


@query(f"""WITH p AS (SELECT case_id, page_index, min(value) AS value, min(conf_bp) AS conf_bp FROM ({plain(_SPONSOR_READS)}) WHERE value IS NOT NULL GROUP BY 1, 2 HAVING min(value) = max(value)
  AND count(DISTINCT string_split(view, '-')[1]) >= 2 AND bool_and(contains(raw, value) OR value NOT IN ({dims.quoted(dims.REVOKED_SPONSORS)})))
SELECT case_id, 'sponsor_id' AS fld, min(value) AS value, min(page_index) AS page_index, first(conf_bp ORDER BY page_index) AS conf_bp FROM p GROUP BY 1 HAVING min(value) = max(value)""")
def sole_gap_fill(spark, sf_dir):
    return R.sole_gap(read(spark, sf_dir, _SPONSOR_READS), "sponsor_id")


_DATE_READS = """SELECT o_custkey AS case_id, o_custkey % 3 + CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS page_index, concat(CASE o_orderkey % 3 WHEN 0 THEN 'raw' ELSE 'otsu' END, '-0') AS view,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN '2026-01-11' ELSE '2026-01-10' END AS value, 30 + o_orderkey % 60 AS conf_bp, o_orderkey % 37 = 0 AS poisoned FROM {orders}"""
_ANCHORS = "SELECT c_custkey AS case_id, CASE WHEN c_custkey % 4 = 0 THEN '2026-01-12' ELSE '2026-01-10' END AS anchor FROM {customer}"


@query(f"""WITH c AS (SELECT case_id, min(page_index) AS page_index, min(value) AS value, min(conf_bp) FILTER (value IS NOT NULL) AS conf_bp FROM ({plain(_DATE_READS)}) GROUP BY 1
  HAVING count(DISTINCT page_index) = 1 AND NOT bool_or(poisoned) AND min(value) = max(value) AND count(DISTINCT string_split(view, '-')[1]) FILTER (value IS NOT NULL) >= 2)
SELECT case_id, 'arrival_on_intake' AS fld, value, page_index, conf_bp FROM c JOIN ({plain(_ANCHORS)}) USING (case_id) WHERE value = anchor""")
def arrival_fill(spark, sf_dir):
    return R.arrival_head(read(spark, sf_dir, _DATE_READS), read(spark, sf_dir, _ANCHORS))


@query()
def discharged_decisions(spark, sf_dir):
    """Every packet decided, its gap filled where a head found a value, and decided again."""
    first = decided(spark, sf_dir)
    found = F.explode(F.array(*(F.struct(F.lit(f).alias("fld"), F.lit(v).alias("value"), F.lit(80).alias("conf_bp")) for f, v in (("fee_status", "paid"), ("sponsor_id", "SPN-1234"), ("visa_class", "XW-3"), ("arrival_on_intake", "seen")))))
    fills = first.select("case_id", found.alias("f")).select("case_id", "f.*")
    return R.discharged(first, fills, dims.path_stats(spark), EngineConfig(discharge=True)).select("case_id", "path", "adjudication", "confidence")


# ------------------------------------------------------------------ the laboratory


@query("SELECT jpeg, blur, skew, noise FROM " + ", ".join("(SELECT unnest([" + ", ".join("NULL" if v is None else f"{v}" + ("" if isinstance(v, int) else "::DOUBLE") for v in vs) + f"]) AS {k})" for k, vs in dims.GRID.items()))
def degradation_grid(spark, sf_dir):
    return L.degradation_grid(spark)


_READS = """SELECT o_orderstatus AS tag, CASE WHEN o_orderkey % 6 > 0 THEN 'paid' END AS expected, CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'waived' ELSE 'paid' END AS value,
  o_totalprice AS score, o_custkey % 100 / 100.0 AS margin FROM {orders}"""


@query(f"""WITH r AS (SELECT *, coalesce(value = expected, false) AS ok FROM ({plain(_READS)}))
SELECT tag, count(*) FILTER (ok) AS ok, count(*) FILTER (value IS NOT NULL AND NOT ok) AS wrong, count(*) FILTER (value IS NULL AND expected IS NOT NULL) AS abstain_genuine, count(*) FILTER (value IS NULL AND expected IS NULL) AS abstain_probe,
  {', '.join(f"min({c}) FILTER (ok)::DOUBLE AS {c}_min, list_sort(list({c}) FILTER (ok))[count(*) FILTER (ok) // 20 + 1]::DOUBLE AS {c}_p5" for c in ('score', 'margin'))} FROM r GROUP BY 1""")
def sweep_tally(spark, sf_dir):
    out = L.tally(read(spark, sf_dir, _READS).withColumn("margin", F.col("margin").cast("double")), ("tag",))
    return out


_REPAIRS = "SELECT p_brand, p_size % 2 AS axis, p_size % 20 AS fragment, p_retailprice AS gain, p_partkey FROM {part}"


@query(f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY p_brand, axis, fragment ORDER BY gain DESC, axis, fragment, p_partkey) AS own FROM ({plain(_REPAIRS)}))
SELECT * EXCLUDE (own) FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY gain DESC, axis, fragment, p_partkey) AS rank FROM d WHERE own = 1) WHERE rank <= 5""")
def ranked_repairs(spark, sf_dir):
    return L.ranked(read(spark, sf_dir, _REPAIRS), ("p_brand",), ("axis", "fragment"), "gain", [F.col(c) for c in ("axis", "fragment", "p_partkey")], 5)


@query("SELECT l_orderkey, t.q AS l_quantity, t.d AS l_shipdate, t.p AS l_partkey FROM (SELECT l_orderkey, min(struct_pack(q := l_quantity, d := l_shipdate, p := l_partkey)) AS t FROM lineitem GROUP BY 1)")
def least_objective(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return L.least(rows, ("l_orderkey",), ("l_quantity", "l_shipdate")).select("l_orderkey", "l_quantity", "l_shipdate", "l_partkey")


_WELDS = "SELECT user_id, event_id % 997 * 1.0 AS score, event_id % 37 AS cut, event_id % 301 - 150 AS shift FROM {events}"


@query(f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY user_id, floor(cut / 5), floor(shift / 16) ORDER BY score DESC, cut DESC, shift DESC) AS own FROM ({plain(_WELDS)}))
SELECT user_id, score::DOUBLE AS score, cut, shift, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, cut DESC, shift DESC) AS rank FROM d WHERE own = 1) WHERE rank <= 3""")
def weld_choice(spark, sf_dir):
    return L.weld_choice(read(spark, sf_dir, _WELDS).withColumn("score", F.col("score").cast("double")), ("user_id",))


@query()
def weld_search(spark, sf_dir):
    """The best welds of bands drawn from embeddings, whose upper parts were moved sideways."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")

    def find(batches):
        for page in batches:
            out = []
            for vec_id, v in zip(page["vec_id"], page["embedding"], strict=True):
                row = np.pad(np.repeat(np.clip(np.asarray(v, float) * 400, 0, 255), 2), 40)
                band = np.tile(row, (24, 1))
                band[:12] = np.roll(row, 20)
                out += [(vec_id, *x) for x in L.weld_scores(band)]
            yield pd.DataFrame(out, columns=["vec_id", "score", "cut", "shift"])

    return L.weld_choice(e.mapInPandas(find, "vec_id long, score double, cut int, shift int"), ("vec_id",))


_RUNS = "SELECT o_orderkey AS run, CASE o_orderkey % 4 WHEN 0 THEN 'pixel_supported' WHEN 1 THEN 'underdetermined' WHEN 2 THEN 'pixel_unsupported' END AS classification FROM {orders}"
_FOUND = """SELECT l_orderkey AS run, l_suppkey AS case_id, l_linenumber AS page_index, l_partkey % 4 AS rotation, l_partkey, map('visa', CASE WHEN l_partkey % 3 = 0 THEN 'XW-3' ELSE 'XW-2' END, CASE WHEN l_partkey % 5 = 0 THEN 'world' ELSE 'fee' END, 'paid') AS values FROM {lineitem}"""
_REVIEWED = "SELECT s_suppkey AS case_id, 1 + s_suppkey % 7 AS page_index, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 4 END AS rotation, map('visa', 'XW-3', 'fee', 'paid') AS expected FROM {supplier} WHERE s_suppkey % 3 > 0"
_REVIEW = """WITH c AS (SELECT l_orderkey AS run, l_partkey, l_suppkey, l_linenumber, l_suppkey % 3 > 0 AND l_linenumber = 1 + l_suppkey % 7 AND (l_suppkey % 2 = 1 OR l_suppkey % 4 = l_partkey % 4) AS applies FROM lineitem),
m AS (SELECT *, CASE WHEN applies THEN l_partkey % 3 = 0 AND l_partkey % 5 > 0 END AS label_match, CASE WHEN applies AND l_partkey % 3 > 0 THEN 'visa' ELSE '' END AS conflicts FROM c)"""


def _review(spark, sf_dir):
    return L.annotated(read(spark, sf_dir, _FOUND), read(spark, sf_dir, _REVIEWED))


@query(_REVIEW + " SELECT run, l_partkey, l_suppkey AS case_id, l_linenumber AS page_index, label_match, conflicts FROM m")
def annotation_join(spark, sf_dir):
    return _review(spark, sf_dir).select("run", "l_partkey", "case_id", "page_index", "label_match", F.array_join("label_conflicts", ",").alias("conflicts"))


@query(_REVIEW + f""", r AS ({plain(_RUNS)}) SELECT (SELECT count(*) FROM r) AS scan_page_rotations, {', '.join(f"(SELECT count(*) FROM r WHERE classification = '{k}') AS {k}" for k in ('pixel_supported', 'underdetermined', 'pixel_unsupported'))},
count(DISTINCT run) AS triggered_rotations, count(*) AS candidate_count, count(*) FILTER (label_match) AS label_matching_candidates, count(*) FILTER (conflicts <> '') AS label_conflicting_candidates FROM m""")
def lab_summary(spark, sf_dir):
    return L.lab_summary(read(spark, sf_dir, _RUNS), _review(spark, sf_dir))
