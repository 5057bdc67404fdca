"""Queries of calibration, candidate scores and geometry."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from evidentia import carriers, dims
from evidentia.carriers import plain, read
from evidentia.catalogue import carrier, decided, query
from evidentia.operators import calibration as C
from evidentia.operators import channels as H
from evidentia.operators import geometry as X
from evidentia.operators import policy as P
from evidentia.oracle import sql
from evidentia.plans.workspace import Workspace

_IX = "cast(substr(case_id, 5) AS BIGINT)"
#: Truth: what the policy says, but for two packets of five.
_TRUTH = f"SELECT case_id, CASE WHEN {_IX} / 8 % 5 = 0 THEN 'APPROVED' WHEN {_IX} / 8 % 5 = 1 THEN 'DENIED' ELSE label0 END AS truth FROM lab"


def decisions(spark, sf_dir):
    """case_id, path, adjudication and the packet's truth."""
    out = decided(spark, sf_dir)
    ix = F.expr("substr(case_id, 5)").cast("long") / 8 % 5
    label0 = P.policy_label_of(F.col("path0"))
    both = out.withColumn("path0", F.col("path")).withColumn("label0", F.coalesce(F.when(F.col("path").startswith("N1"), F.lit("NEEDS_REVIEW")), label0))
    return both.select("case_id", "path", "adjudication", F.when(ix == 0, "APPROVED").when(ix == 1, "DENIED").otherwise(F.col("label0")).alias("truth"))


def _split(spark, sf_dir):
    d = Workspace(spark, "calibration").table("decisions", decisions(spark, sf_dir))  # both sides of a join read them
    return d.drop("truth"), d.select("case_id", "truth")


_D = {"truth": _TRUTH, "dt": "SELECT case_id, path, adjudication, truth FROM dec JOIN truth USING (case_id)",
      "pt": "SELECT path, count(*) AS n, count(*) FILTER (adjudication = truth) AS correct, " + ", ".join(f"count(*) FILTER (truth = '{c}' AND adjudication <> '{c}') AS err_{c.lower()}" for c in dims.LABELS) + " FROM dt GROUP BY path",
      "pf": "SELECT path, count(*) AS n, count(*) FILTER (adjudication = truth) AS correct FROM dt WHERE cast(substr(case_id, 5) AS BIGINT) / 8 % 5 <> 0 GROUP BY path",
      "q0": "SELECT sum(correct) / greatest(sum(n), 1) AS q FROM pf"}


@query(sql("SELECT * FROM pt", **_D))
def path_accuracy(spark, sf_dir):
    return C.path_table(*_split(spark, sf_dir))


@query(sql("SELECT path, n, correct, round((correct + 10 * q) / (n + 10), 9) AS accuracy, " + ", ".join(f"round(err_{c.lower()} / greatest(n - correct, 1), 9) AS share_{c.lower()}" for c in dims.LABELS) + " FROM pt, (SELECT sum(correct) / sum(n) AS q FROM pt)", **_D))
def shrunk_calibration(spark, sf_dir):
    out = C.shrunk(C.path_table(*_split(spark, sf_dir)))
    return out.select("path", "n", "correct", *(F.round(c, 9).alias(c) for c in ("accuracy", *(f"share_{x.lower()}" for x in dims.LABELS))))


@query(sql("""SELECT count(*) AS n, round(avg(r), 9) AS accuracy, round(avg((q - r) * (q - r)), 9) AS brier, round(20 * greatest(0, 1 - 2 * avg((q - r) * (q - r))), 9) AS points FROM (
  SELECT (adjudication = truth)::INT::DOUBLE AS r, coalesce((f.correct + 10 * q0.q) / (f.n + 10), q0.q) AS q FROM dt LEFT JOIN pf f USING (path), q0 WHERE cast(substr(case_id, 5) AS BIGINT) / 8 % 5 = 0)""", **_D))
def brier_holdout(spark, sf_dir):
    held = F.expr("substr(case_id, 5)").cast("long") / 8 % 5 == 0
    out = C.holdout_check(*_split(spark, sf_dir), held)
    return out.select("n", *(F.round(c, 9).alias(c) for c in ("accuracy", "brier", "points")))


@query(sql("SELECT truth, adjudication, count(*) AS n, truth = 'DENIED' AND adjudication = 'APPROVED' AS catastrophic FROM dt GROUP BY 1, 2", **_D))
def confusion_matrix(spark, sf_dir):
    return C.confusion(*_split(spark, sf_dir))


_GOLD = ", ".join(f"CASE WHEN {_IX} / 8 % {3 + i} = 0 THEN 'other' ELSE upper({f}) END AS gold_{f}" for i, f in enumerate(dims.FIELD_WEIGHTS))


@query(sql("SELECT fld, hits, n, round(hits / n, 9) AS accuracy, round(50 * weight * hits / n / 45, 9) AS points FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS fld, {w} AS weight, count(*) FILTER (" + (f"{f} = lower(gold_{f})" if f == "risk_flags" else f"lower({f}) = lower(gold_{f})") + f") AS hits, count(*) AS n FROM (SELECT *, {_GOLD} FROM row)" for f, w in dims.FIELD_WEIGHTS.items()) + ")"))
def field_accuracy(spark, sf_dir):
    rows = Workspace(spark, "accuracy").table("rows", P.build_row(decided(spark, sf_dir)))
    ix = F.expr("substr(case_id, 5)").cast("long") / 8
    gold = rows.select("case_id", *(F.when(ix % (3 + i) == 0, "other").otherwise(F.upper(f)).alias(f) for i, f in enumerate(dims.FIELD_WEIGHTS)))
    out = C.field_accuracy(rows, gold)
    return out.select("fld", "hits", "n", F.round("accuracy", 9).alias("accuracy"), F.round("points", 9).alias("points"))


# ------------------------------------------------------------------ candidate scores

_MENU = (*dims.WORLDS[:12], H.NONE)
_SCORES = "SELECT label AS case_ix, vec_id % 3 AS page_index, vec_id, CASE k " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_MENU)) + " END AS value, cast(embedding[{at}] AS DOUBLE) - 1 AS score FROM {{embeddings}}"
_SPARK_SCORES = _SCORES.replace("{at}", "k").replace("{{", "{").replace("}}", "}") + " LATERAL VIEW explode(sequence(0, 12)) x AS k"
_DUCK_SCORES = _SCORES.replace("{at}", "k + 1").replace("{{embeddings}}", "embeddings, (SELECT unnest(range(0, 13)) AS k)")


@query(f"""WITH s AS ({_DUCK_SCORES}), p AS (SELECT case_ix, page_index, value, avg(score) AS s FROM s GROUP BY 1, 2, 3), c AS (SELECT case_ix, value, avg(s) AS s FROM p GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER o AS rn, lead(s) OVER o AS nx FROM c WHERE value <> '<none>' WINDOW o AS (PARTITION BY case_ix ORDER BY s DESC, value DESC)), n AS (SELECT case_ix, s AS ns FROM c WHERE value = '<none>')
SELECT case_ix, value, round(s, 6) AS score, round(s - nx, 6) AS margin FROM r LEFT JOIN n USING (case_ix) WHERE rn = 1 AND s >= ns AND s >= -3.5 AND s - nx >= 0.001""")
def menu_fusion(spark, sf_dir):
    """Scores of views pooled by page and then by case, and the gate; the margin is fitted to these scores' scale."""
    scores = read(spark, sf_dir, _SPARK_SCORES)
    pooled = H.fuse(H.fuse(scores, ("case_ix", "page_index")), ("case_ix",))
    return H.gate(pooled, ("case_ix",), margin=0.001).select("case_ix", "value", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"))


@query(f"""WITH s AS ({_DUCK_SCORES}), p AS (SELECT case_ix, page_index, value, avg(score) AS s FROM s GROUP BY 1, 2, 3), w AS (SELECT case_ix, page_index, first(value ORDER BY s DESC, value DESC) AS value FROM p GROUP BY 1, 2)
SELECT case_ix, min(value) AS value, count(*) AS pages FROM w GROUP BY 1 HAVING min(value) = max(value)""")
def cross_page_agreement(spark, sf_dir):
    pages = H.fuse(read(spark, sf_dir, _SPARK_SCORES), ("case_ix", "page_index")).groupBy("case_ix", "page_index").agg(F.max(F.struct("score", "value")).alias("t"))
    agreed = H.agree_across_pages(pages.select(F.col("case_ix").alias("case_id"), F.lit("home_world").alias("fld"), F.col("t.value").alias("value")))
    n = pages.groupBy("case_ix").agg(F.count(F.lit(1)).alias("pages"))
    return agreed.select(F.col("case_id").alias("case_ix"), "value").join(n, "case_ix")


@query()
def ctc_forward(spark, sf_dir):
    """Embeddings as posteriors of sixteen frames of four classes, scored against two labels."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    frame = lambda i: F.slice("embedding", F.lit(1) + i * 4, F.lit(4))
    total = lambda r: F.log(F.aggregate(r, F.lit(0.0), lambda s, v: s + F.exp(v.cast("double"))))
    logs = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.transform(F.array(frame(i)), lambda r: F.transform(r, lambda v: v.cast("double") - total(r)))[0])
    menu = spark.createDataFrame([("ab", [1, 2]), ("aab", [1, 1, 2])], "value string, labels array<int>")
    return H.score_menu(e.select("vec_id", logs.alias("frames")), menu).select("vec_id", "value", F.round("score", 9).alias("score"))


@query("""WITH t AS (SELECT label, list_transform(range(1, 65), lambda i: m[i]) AS tp FROM (SELECT label, list(v ORDER BY i) AS m FROM (SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2) GROUP BY 1)),
s AS (SELECT e.vec_id, t.label AS value, (SELECT corr(x, y) FROM (SELECT unnest(e.embedding)::DOUBLE AS x, unnest(t.tp) AS y)) AS c FROM embeddings e, t),
r AS (SELECT *, row_number() OVER o AS rn, lead(c) OVER o AS nx FROM s WINDOW o AS (PARTITION BY vec_id ORDER BY c DESC, value))
SELECT vec_id AS patch, 'T' || value AS value, round(c, 6) AS score FROM r WHERE rn = 1 AND c >= 0.45 AND c - nx >= 0.03""")
def ncc_rank(spark, sf_dir):
    """Embeddings as patches against their classes' means, a closed menu."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    means = e.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    lists = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("m"))  # 64 entries a label
    templates = lists.select(F.concat(F.lit("T"), F.col("label")).alias("value"), F.transform("m", lambda x: x["v"]).alias("pixels"))
    return H.rank_patches(e.select(F.col("vec_id").alias("patch"), F.col("embedding").cast("array<double>").alias("pixels")), templates).select("patch", "value", F.round("score", 6).alias("score"))


_VIEWS = "SELECT user_id AS case_id, event_type AS fld, CASE WHEN event_id % 17 = 0 THEN 'B' ELSE 'A' END AS value, concat(CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'otsu' ELSE 'ppocr' END, '-', cast(event_id % 2 AS VARCHAR(2))) AS view FROM {events}"


@query(f"SELECT case_id, fld, min(value) AS value, count(DISTINCT string_split(view, '-')[1]) AS families FROM ({plain(_VIEWS)}) GROUP BY 1, 2 HAVING min(value) = max(value) AND count(DISTINCT string_split(view, '-')[1]) >= 2")
def family_agreement(spark, sf_dir):
    return H.family_agreement(read(spark, sf_dir, _VIEWS))


_ADV = "SELECT user_id AS case_id, event_type AS fld, CASE WHEN event_id % 5 = 0 THEN 'B' ELSE 'C' END AS value, value / 100 AS advantage FROM {events}"


@query(f"""WITH f AS (SELECT case_id, fld, min(value) AS value FROM ({plain(_VIEWS)}) GROUP BY 1, 2), p AS ({plain(_ADV)})
SELECT f.* FROM f WHERE NOT (EXISTS (SELECT 1 FROM p WHERE p.case_id = f.case_id AND p.fld = f.fld AND p.value <> f.value AND advantage >= 0.2) AND NOT EXISTS (SELECT 1 FROM p WHERE p.case_id = f.case_id AND p.fld = f.fld AND p.value = f.value))""")
def cross_channel_veto(spark, sf_dir):
    fills = read(spark, sf_dir, _VIEWS).groupBy("case_id", "fld").agg(F.min("value").alias("value"))
    return H.veto(fills, read(spark, sf_dir, _ADV))


@query()
def stamp_detector(spark, sf_dir):
    """Connected marks of a synthetic page's mask that have a stamp's shape; the mask is drawn from each embedding."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")

    def find(page: pd.DataFrame) -> pd.DataFrame:
        out = []
        for vec_id, vector in zip(page["vec_id"], page["embedding"], strict=True):
            mask = np.zeros((160, 240), bool)
            x, y = (int(abs(v) * 400) % 100 for v in vector[:2])
            mask[y : y + 24, x : x + 100 : 2] = True
            mask[150:156, :6] = True
            out += [(vec_id, *b) for b in H.stamp_boxes(mask)]
        return pd.DataFrame(out, columns=["vec_id", "x", "y", "w", "h", "px"])

    return e.mapInPandas(lambda it: map(find, it), "vec_id long, x int, y int, w int, h int, px int")


# ------------------------------------------------------------------ geometry

_POINTS = "SELECT user_id, event_id / 10 AS x, value AS y FROM {events}"


@query("""WITH p AS (SELECT user_id, event_id / 10 AS x, value AS y FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x, y) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM p),
k AS (SELECT * FROM n WHERE n <= 60 OR list_contains(list_transform(range(0, 60), lambda q: (q * (n - 1)) // 59), i)), s AS (SELECT a.user_id, median((a.y - b.y) / (a.x - b.x)) AS slope FROM k a JOIN k b ON a.user_id = b.user_id AND a.i < b.i AND a.x <> b.x GROUP BY 1)
SELECT user_id, round(slope, 6) AS slope, round(median(y - slope * x), 6) AS intercept FROM k JOIN s USING (user_id) GROUP BY user_id, slope""")
def theil_sen(spark, sf_dir):
    """Robust lines through each user's values over time."""
    return X.theil_sen(read(spark, sf_dir, _POINTS), "user_id").select("user_id", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


_BANDS = "SELECT o_custkey % 50 AS page, o_orderkey AS band, o_custkey % 700 AS lo, o_custkey % 700 + 1 + o_orderkey % 40 AS hi FROM {orders}"
_WANTED = "SELECT s_nationkey AS page, s_suppkey * 7 % 700 AS r_lo, s_suppkey * 7 % 700 + 5 AS r_hi FROM {supplier}"


@query(f"WITH b AS ({plain(_BANDS)}), w AS ({plain(_WANTED)}) SELECT b.* FROM b WHERE EXISTS (SELECT 1 FROM w WHERE w.page = b.page AND lo < r_hi AND hi > r_lo) OR NOT EXISTS (SELECT 1 FROM w WHERE w.page = b.page)")
def band_overlap(spark, sf_dir):
    """Bands that overlap what a page wants; pages that state nothing want all."""
    return X.bands_wanted(read(spark, sf_dir, _BANDS), read(spark, sf_dir, _WANTED), ("page",), 64)


_SEAMS = "SELECT p_partkey % 50 AS page, p_partkey AS seam, p_size * 14 AS place, p_partkey % 300 AS lo, p_partkey % 300 + 40 AS hi FROM {part}"
_REGIONS = "SELECT s_nationkey AS page, s_suppkey AS region, s_suppkey * 7 % 600 AS r_lo, s_suppkey * 7 % 600 + 90 AS r_hi, s_suppkey * 3 % 250 AS cross_lo, s_suppkey * 3 % 250 + 60 AS cross_hi FROM {supplier}"


@query(f"WITH s AS ({plain(_SEAMS)}), r AS ({plain(_REGIONS)}) SELECT s.page, seam, region FROM s JOIN r ON s.page = r.page AND place > r_lo AND place < r_hi AND hi > cross_lo AND lo < cross_hi")
def seam_containment(spark, sf_dir):
    return X.contained(read(spark, sf_dir, _SEAMS).withColumnRenamed("place", "at"), read(spark, sf_dir, _REGIONS), ("page",), 64).select("page", "seam", "region")


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS turn FROM part) SELECT p_partkey, p_brand, turn::INT AS turn FROM r WHERE turn <= 60 ORDER BY r.turn, p_brand LIMIT 60")
def round_robin_topk(spark, sf_dir):
    """Sixty parts taken in turns from brands, the dearest first."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return X.round_robin(part, "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], [F.col("p_brand")], 60).select("p_partkey", "p_brand", "turn")


_SEG = "SELECT user_id, round(value * 3) / 3 AS angle, event_id % 300 AS length FROM {events}"


@query(f"WITH v AS (SELECT user_id, round(angle * 2) / 2 AS a, sum(least(length, 200)) AS w FROM ({plain(_SEG)}) GROUP BY 1, 2) SELECT user_id, CASE WHEN max(w) > 0 THEN first(a ORDER BY w DESC, abs(a), a DESC) ELSE 0 END AS angle FROM v GROUP BY 1")
def angle_histogram(spark, sf_dir):
    return X.angle_vote(read(spark, sf_dir, _SEG), "user_id")


@query("""WITH r AS (SELECT user_id, event_type, value AS residual, event_id % 4 <> 0 AS observed FROM events), o AS (SELECT user_id, event_type, avg(observed::INT) AS share, median(residual) FILTER (observed) AS dx FROM r GROUP BY 1, 2),
m AS (SELECT user_id, event_type, median(abs(residual - dx)) AS mad FROM r JOIN o USING (user_id, event_type) WHERE observed GROUP BY 1, 2) SELECT user_id, event_type, round(dx, 9) AS dx FROM o JOIN m USING (user_id, event_type) WHERE share >= 0.5 AND mad <= 6""")
def rail_displacement(spark, sf_dir):
    """Median displacement of a rail where it is mostly seen and flat."""
    s = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_type", F.col("value").alias("residual"), (F.col("event_id") % 4 != 0).alias("observed"))
    return X.flat_displacement(s, ("user_id", "event_type"), flatness=6.0).withColumn("dx", F.round("dx", 9))


@query()
def profile_periods(spark, sf_dir):
    """Periods of each user's hourly activity."""
    hours = read(spark, sf_dir, "SELECT user_id, cast(floor(event_id / 100) AS INT) AS slot, count(*) AS n FROM {events} GROUP BY 1, 2")

    def find(page: pd.DataFrame) -> pd.DataFrame:
        profile = np.zeros(int(page["slot"].max()) + 1)
        profile[page["slot"]] = page["n"]
        return pd.DataFrame([(page["user_id"].iloc[0], ",".join(map(str, X.periods(profile))))], columns=["user_id", "periods"])

    return X.per_page(hours, ("user_id",), find, "user_id long, periods string")


@query()
def offset_paths(spark, sf_dir):
    """Piecewise constant offsets through each embedding's bins of scores."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")

    def find(batches):
        for page in batches:
            states = np.arange(-3, 5)
            paths = [X.offset_path(np.asarray(v, float).reshape(8, 8), states) for v in page["embedding"]]
            yield pd.DataFrame({"vec_id": page["vec_id"], "path": [",".join(map(str, p)) for p in paths]})

    return e.mapInPandas(find, "vec_id long, path string")


@query()
def endpoint_pairing(spark, sf_dir):
    """One-to-one matches of rail ends on two sides of a seam."""
    ends = read(spark, sf_dir, "SELECT o_custkey AS page, o_orderkey % 2 AS side, cast(o_totalprice AS BIGINT) % 500 AS at FROM {orders}")

    def pair(page: pd.DataFrame) -> pd.DataFrame:
        a, b = (sorted(page.loc[page["side"] == s, "at"].astype(float)) for s in (0, 1))
        found = X.match_endpoints(a, b, 2.0, 25.0)
        return pd.DataFrame([(page["page"].iloc[0], a[i], b[j]) for i, j in found], columns=["page", "before", "after"])

    return X.per_page(ends, ("page",), pair, "page long, before double, after double")
