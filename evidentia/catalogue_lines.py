"""Queries over pages, lines, spans and words."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import carriers, dims
from evidentia.carriers import case_of, mib, padded, plain, read
from evidentia.catalogue import query
from evidentia.operators import pages as G

#: Every document as a page of the packet of its id, its lines in order; every eleventh names another packet in its footer.
DOC_LINES = f"""SELECT {case_of('doc_id')} AS case_id, doc_id AS page_index, pos AS line_ord, t AS text, CASE WHEN doc_id % 3 = 0 THEN 'ocr' ELSE 'digital' END AS source,
  40 + (doc_id * 7 + pos * 13) % 60 AS conf_bp FROM {{documents}} LATERAL VIEW posexplode(split(text, '\\n')) x AS pos, t"""
_DL = f"""SELECT {case_of('doc_id')} AS case_id, doc_id AS page_index, pos - 1 AS line_ord, parts[pos] AS text, CASE WHEN doc_id % 3 = 0 THEN 'ocr' ELSE 'digital' END AS source,
  40 + (doc_id * 7 + (pos - 1) * 13) % 60 AS conf_bp FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))"""
FOOTERS = f"""SELECT {case_of('doc_id')} AS case_id, doc_id AS page_index,
  concat('Packet ', {mib('CASE WHEN doc_id % 11 = 0 THEN doc_id + 999 ELSE doc_id - doc_id % 8 END')}, ' / page 1') AS text FROM {{documents}}"""


def doc_lines(spark, sf_dir):
    return read(spark, sf_dir, DOC_LINES)


@query(f"WITH l AS ({_DL}), f AS ({plain(FOOTERS)}) SELECT l.case_id, l.page_index, count(*) AS n FROM l JOIN f USING (case_id, page_index) WHERE regexp_extract(f.text, 'MIB-[0-9]+') = l.case_id GROUP BY 1, 2")
def foreign_page_drop(spark, sf_dir):
    kept = G.drop_foreign(doc_lines(spark, sf_dir), read(spark, sf_dir, FOOTERS))
    return kept.groupBy("case_id", "page_index").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH l AS ({_DL}), c AS (SELECT page_index, min(line_ord) AS cut FROM l WHERE source = 'digital' AND contains(lower(text), 'license') GROUP BY 1)
SELECT l.page_index, count(*) AS n, max(line_ord) AS last FROM l LEFT JOIN c USING (page_index) WHERE cut IS NULL OR line_ord < cut GROUP BY 1""")
def decoy_trim(spark, sf_dir):
    """Pages end where another applicant's block begins; here the word license begins it."""
    return G.trim_decoys(doc_lines(spark, sf_dir), "license").groupBy("page_index").agg(F.count(F.lit(1)).alias("n"), F.max("line_ord").alias("last"))


@query(f"""WITH l AS ({_DL}), u AS (SELECT * FROM l UNION ALL SELECT case_id, page_index, line_ord + 100000, translate(text, 'aeiou', 'AEIOU'), source, conf_bp + 1 - 2 * (line_ord % 2) FROM l),
n AS (SELECT *, lower(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) AS norm FROM u)
SELECT case_id, page_index, min(line_ord) AS line_ord, first(text ORDER BY conf_bp DESC, line_ord) AS text, max(conf_bp) AS conf_bp FROM n GROUP BY case_id, page_index, norm""")
def line_dedup_pool(spark, sf_dir):
    """Two passes over the pages, pooled; the second reads capital vowels."""
    first = doc_lines(spark, sf_dir)
    second = first.withColumns({"conf_bp": F.col("conf_bp") + 1 - 2 * (F.col("line_ord") % 2), "text": F.translate("text", "aeiou", "AEIOU"), "line_ord": F.col("line_ord") + 100000})
    return G.pool_passes(first.unionByName(second))


@query(f"""WITH l AS ({_DL}), s AS (SELECT *, line_ord % 3 = 1 AS skip, line_ord % 4 = 0 AS is_finding FROM l),
w AS (SELECT *, lead(text, 1) OVER o AS t1, lead(skip, 1) OVER o AS s1, lead(text, 2) OVER o AS t2, lead(skip, 2) OVER o AS s2 FROM s WINDOW o AS (PARTITION BY case_id, page_index ORDER BY line_ord))
SELECT case_id, page_index, line_ord, concat_ws(' ', text, CASE WHEN NOT s1 THEN t1 END, CASE WHEN NOT s2 THEN t2 END) AS reason FROM w WHERE is_finding""")
def reason_continuation(spark, sf_dir):
    lines = doc_lines(spark, sf_dir).withColumns({"skip": F.col("line_ord") % 3 == 1, "is_finding": F.col("line_ord") % 4 == 0, "tail": F.col("text")})
    return G.continued_reasons(lines)


_SPANS = """SELECT l_orderkey AS page_index, concat('span ', cast(l_partkey AS VARCHAR(12))) AS text, l_extendedprice / 100 - 20 AS x0, l_quantity * 16 AS y0, l_extendedprice / 100 + 20 AS x1, l_quantity * 16 + 10 AS y1,
  l_suppkey % 11 + 2.0 AS size, CASE WHEN l_partkey % 7 = 0 THEN 1.0 ELSE l_discount * 5 END AS tone, CASE WHEN l_partkey % 13 = 0 THEN 0.0 ELSE 1.0 END AS opacity,
  CASE WHEN l_suppkey % 17 = 0 THEN 3 ELSE 0 END AS render_type, l_linenumber AS ord FROM {lineitem}"""


@query(f"""WITH s AS ({plain(_SPANS)}) SELECT page_index, ord, text, concat_ws(',', CASE WHEN render_type = 3 THEN 'invisible_render_mode' END, CASE WHEN opacity = 0 THEN 'zero_opacity' END, CASE WHEN size < 6 THEN 'tiny_font' END,
  CASE WHEN tone >= 0.92 THEN 'near_white_fill' END, CASE WHEN x1 <= 0 OR y1 <= 0 OR x0 >= 612 OR y0 >= 792 THEN 'outside_cropbox' END) AS reasons FROM s""")
def hidden_spans(spark, sf_dir):
    """Order lines as spans of a page, with the reasons for which a reader cannot see them."""
    spans = read(spark, sf_dir, _SPANS).withColumns({"color": F.array("tone", F.lit(1.0)), "page_w": F.lit(612.0), "page_h": F.lit(792.0)})
    return G.hidden_reasons(spans).select("page_index", "ord", "text", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH s AS ({plain(_SPANS)}) SELECT page_index, CASE WHEN max((x1 - x0) * (y1 - y0) * (2 + ord) / (CASE WHEN page_index % 5 = 0 THEN NULL ELSE 2400 END)) >= 0.5 THEN 'scan' ELSE 'digital' END AS kind FROM s GROUP BY 1")
def page_typing(spark, sf_dir):
    spans = read(spark, sf_dir, _SPANS)
    images = spans.select(F.lit("MIB-000000").alias("case_id"), "page_index", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) * (2 + F.col("ord"))).alias("img_area"), F.when(F.col("page_index") % 5 == 0, 0).otherwise(2400).alias("page_area"))
    return G.page_kinds(images).select("page_index", "kind")


@query(r"""SELECT page_id, length(t) AS n_visible, t AS visible FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g'),
  '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\r]+', ' ', 'g')) AS t FROM pages)""")
def hidden_text_filter(spark, sf_dir):
    """Web pages without scripts, styles and comments, which no reader sees."""
    html = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html.select("page_id", G.visible_html(F.col("html")).alias("visible")).select("page_id", F.length("visible").cast("bigint").alias("n_visible"), "visible")


_TAGS = (("<h1", "Case ID"), ("<p>", "Applicant"), ("<b>", "Species Code"), ("<ul", "Home World"), ("ad 1", "Registry Name"), ("ad 2", "Registry Status"), ("<footer", "Arrival Date"), ("<br>", "Declared Purpose"))


@query("WITH h AS (" + " UNION ALL ".join(f"SELECT page_id AS page_index, '{x}' AS label FROM pages WHERE contains(html, '{t}')" for t, x in _TAGS) + "), k(doc_type, label, points) AS (VALUES "
       + ", ".join(f"('{t}', '{x}', {2 if x in dims.TYPE_DISTINCTIVE[t] else 1})" for t, xs in dims.TYPE_LABELS.items() for x in xs)
       + "), s AS (SELECT page_index, doc_type, sum(points)::BIGINT AS points FROM h JOIN k USING (label) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER o AS rn, lead(points) OVER o AS nx FROM s WINDOW o AS (PARTITION BY page_index ORDER BY points DESC, doc_type)) "
       "SELECT page_index, doc_type, points FROM r WHERE rn = 1 AND points >= 3 AND points > coalesce(nx, 0)")
def doc_typing_labels(spark, sf_dir):
    """Types of pages by the labels on them; here tags stand for labels."""
    html = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = F.array_compact(F.array(*(F.when(F.contains("html", F.lit(t)), F.lit(x)) for t, x in _TAGS)))
    labels = html.select(F.lit("MIB-000000").alias("case_id"), F.col("page_id").alias("page_index"), F.explode(found).alias("label"))
    return G.type_by_labels(labels).select("page_index", "doc_type", "points")


@query()
def row_grouping(spark, sf_dir):
    """Order lines as spans (x: price, y: quantity), grouped in rows around each row's first."""
    spans = read(spark, sf_dir, "SELECT l_orderkey AS page_index, l_extendedprice AS x, l_quantity AS y FROM {lineitem}")
    return G.rows_of(spans, ("page_index",)).groupBy("page_index", "row").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("top"))


@query()
def line_assembly(spark, sf_dir):
    """Lines of an order's visible spans."""
    spans = read(spark, sf_dir, _SPANS).withColumns({"case_id": F.lit("MIB-000000"), "color": F.array("tone", F.lit(1.0)), "page_w": F.lit(612.0), "page_h": F.lit(792.0), "italic": F.col("ord") == 3})
    return G.assemble_lines(G.visible(spans)).drop("case_id")


@query("""WITH m AS (SELECT DISTINCT user_id, cast(floor(epoch(ts) / 60) AS BIGINT) AS minute FROM events), s AS (SELECT *, CASE WHEN minute - lag(minute) OVER (PARTITION BY user_id ORDER BY minute) <= 240 THEN 0 ELSE 1 END AS st FROM m),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY minute) AS island FROM s) SELECT user_id, min(minute) AS first, max(minute) AS last, count(*) AS n FROM i GROUP BY user_id, island HAVING count(*) >= 2""")
def gaps_islands(spark, sf_dir):
    """Runs of a user's active minutes with gaps of at most four hours."""
    minutes = read(spark, sf_dir, "SELECT DISTINCT user_id, floor(unix_micros(cast(ts AS timestamp)) / 60000000) AS minute FROM {events}")
    return G.islands(minutes, "user_id", "minute", 240, 2)


_WORDS = f"""SELECT {case_of('l_orderkey')} AS case_id, l_linenumber AS page_index,
  row_number() OVER (PARTITION BY l_orderkey - l_orderkey % 8, l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, abs(l_discount), abs(l_tax), l_returnflag, l_linestatus, l_shipdate) AS word_ord,
  CASE l_partkey % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Class:' ELSE 'other' END AS text, 50 + 5 * (l_suppkey % 10) AS conf_bp,
  cast(l_partkey % 40 * 10 AS BIGINT) AS x, cast(l_quantity AS BIGINT) % 6 * 5 AS y, 90 + l_suppkey % 3 AS w, 20 + l_suppkey % 4 AS h FROM {{lineitem}}"""


@query(f"""WITH w0 AS ({plain(_WORDS)}), n AS (SELECT *, lead(text) OVER o AS nt, lead(conf_bp) OVER o AS nc, lead(x) OVER o AS nx, lead(y) OVER o AS ny, lead(w) OVER o AS nw, lead(h) OVER o AS nh FROM w0 WINDOW o AS (PARTITION BY case_id, page_index ORDER BY word_ord)),
f AS (SELECT case_id, page_index, (least(y, ny) + greatest(y + h, ny + nh)) // 24 AS row, least(conf_bp, nc) AS conf_bp, x, y, word_ord FROM n WHERE text = 'Visa' AND nt = 'Class:' AND least(conf_bp, nc) >= 60 AND abs(y - ny) <= greatest(h, nh) AND nx > x + w * 0.5 AND nx < x + w + 3 * h)
SELECT case_id, page_index, row, max(conf_bp) AS conf_bp, first(x ORDER BY conf_bp DESC, word_ord) AS x, first(y ORDER BY conf_bp DESC, word_ord) AS y FROM f GROUP BY 1, 2, 3""")
def label_run_locator(spark, sf_dir):
    return G.label_runs(read(spark, sf_dir, _WORDS), "visa", "class")


@query(f"WITH w0 AS ({plain(_WORDS)}) SELECT case_id, page_index, y AS line, string_agg(text, ' ' ORDER BY x, word_ord) AS text, round(avg(conf_bp / 100), 9) AS conf FROM w0 GROUP BY 1, 2, 3")
def words_to_lines(spark, sf_dir):
    words = read(spark, sf_dir, _WORDS).withColumns({"block": F.lit(0), "par": F.lit(0), "line": F.col("y"), "conf": F.col("conf_bp") / 100})
    return G.words_to_lines(words).select("case_id", "page_index", "line", "text", F.round("conf", 9).alias("conf"))


_READS = f"""SELECT {case_of('l_orderkey')} AS case_id, l_linenumber AS page_index,
  concat(cast(l_orderkey / 8 % 7 AS INT), CASE WHEN l_partkey % 9 = 0 THEN 'X' ELSE '5' END, cast(cast(l_orderkey - l_orderkey % 8 AS BIGINT) % 10 AS INT), CASE WHEN l_suppkey % 5 = 0 THEN '7' ELSE '3' END) AS grp FROM {{lineitem}}"""
_READS = _READS.replace("cast(l_orderkey / 8 % 7 AS INT)", "cast((l_orderkey - l_orderkey % 8) / 8 % 7 AS BIGINT)").replace("cast(cast(l_orderkey - l_orderkey % 8 AS BIGINT) % 10 AS INT)", "cast((l_orderkey - l_orderkey % 8) % 10 AS BIGINT)")


@query(f"""WITH r AS (SELECT DISTINCT * FROM ({plain(_READS)}) WHERE length(regexp_replace(grp, '[^0-9]', '', 'g')) >= 2), ok AS (SELECT case_id FROM r GROUP BY 1 HAVING count(DISTINCT page_index) >= 2),
p AS (SELECT case_id, i, substr(grp, i, 1) AS ch, count(*) AS n FROM (SELECT r.*, unnest([1, 2, 3, 4]) AS i FROM r JOIN ok USING (case_id)) GROUP BY 1, 2, 3),
t AS (SELECT case_id, i, max(n) AS n FROM p GROUP BY 1, 2), b AS (SELECT p.case_id, p.i, min(ch) AS ch, count(*) AS k FROM p JOIN t USING (case_id, i, n) GROUP BY 1, 2)
SELECT case_id, 'SPN-' || string_agg(ch, '' ORDER BY i) AS sponsor_id FROM b GROUP BY 1 HAVING max(k) = 1 AND regexp_matches(string_agg(ch, '' ORDER BY i), '^[0-9]{{4}}$') AND 'SPN-' || string_agg(ch, '' ORDER BY i) NOT IN ({dims.quoted(dims.REVOKED_SPONSORS)})""")
def digit_majority_vote(spark, sf_dir):
    """Sponsor ids by a vote at each place over the pages' garbled reads."""
    return G.digit_vote(read(spark, sf_dir, _READS).withColumnRenamed("grp", "group"))


_LETTER = f"""SELECT {case_of('c_custkey')} AS case_id, c_custkey AS page_index, k AS line_ord, CASE k WHEN 0 THEN concat('Sponsor SPN-', {padded('c_custkey % 10000', 4)}, ' attests that') WHEN 1 THEN concat('{carriers.VALUES['applicant_name'][0]}', ' is expected')
  ELSE 'on Earth for archive audit. Held to class MED-3 compliance' END AS text, 90 + k AS conf_bp, CASE WHEN c_custkey % 2 = 0 THEN 'digital' ELSE 'ocr' END AS source"""


@query(f"""SELECT {case_of('c_custkey')} AS case_id, c_custkey AS page_index, fld, CASE fld WHEN 'sponsor_id' THEN 'SPN-' || {padded('c_custkey % 10000', 4)} WHEN 'applicant_name' THEN 'Aririx Ixozarn' WHEN 'visa_class' THEN 'MED-3' ELSE 'archive audit' END AS raw, 90 AS conf_bp,
  CASE WHEN c_custkey % 2 = 0 THEN 'digital' ELSE 'ocr' END AS source FROM customer, (VALUES ('sponsor_id'), ('applicant_name'), ('visa_class'), ('declared_purpose')) f(fld)""")
def prose_attestation(spark, sf_dir):
    """Values of attestation letters written as prose over three lines."""
    letters = read(spark, sf_dir, f"{_LETTER} FROM {{customer}} LATERAL VIEW explode(array(0, 1, 2)) x AS k")
    return G.prose_values(letters)
