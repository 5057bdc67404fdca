"""Spans, lines and words of pages: what is hidden, foreign or a decoy, and how lines come about.

All partition by packet and page, whose rows are few; a packet is self-contained, so its key deals the work evenly.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.functions import match as M
from evidentia.functions import text as T

PAGE = ("case_id", "page_index")


def hidden_reasons(spans: DataFrame) -> DataFrame:
    """spans with reasons: why a reader of the page cannot see a span. Spans without a colour are not white.

    spans: text, x0, y0, x1, y1, size, color, opacity, render_type, page_w, page_h.
    """
    outside = (F.col("x1") <= 0) | (F.col("y1") <= 0) | (F.col("x0") >= F.col("page_w")) | (F.col("y0") >= F.col("page_h"))
    white = F.coalesce((F.size("color") > 0) & (F.array_min("color") >= 0.92), F.lit(False))
    tests = [(F.col("render_type") == 3, "invisible_render_mode"), (F.col("opacity") == 0, "zero_opacity"), (F.col("size") < 6, "tiny_font"), (white, "near_white_fill"), (outside, "outside_cropbox")]
    return spans.withColumn("reasons", F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in tests))))


def visible(spans: DataFrame) -> DataFrame:
    """Spans that are not blank and that a reader can see."""
    return hidden_reasons(spans).filter((F.trim("text") != "") & (F.size("reasons") == 0))


def page_kinds(images: DataFrame) -> DataFrame:
    """case_id, page_index, kind: scan if one picture covers half the page; a page without area is digital."""
    share = F.when(F.col("page_area") > 0, F.col("img_area") / F.col("page_area"))
    return images.groupBy(*PAGE).agg(F.max(share).alias("cover")).select(*PAGE, F.when(F.col("cover") >= 0.5, "scan").otherwise("digital").alias("kind"))


def drop_foreign(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """lines without pages whose own digital footer names another case."""
    named = F.nullif(F.regexp_extract("text", T.FOOTER, 1), F.lit(""))
    foreign = spans.filter(named.isNotNull() & (named != F.col("case_id"))).select(*PAGE).distinct()
    return lines.join(foreign, list(PAGE), "left_anti")


def trim_decoys(lines: DataFrame, marker: str = "adjacent applicant") -> DataFrame:
    """lines up to the page's first digital one that begins another applicant's block."""
    other = T.repair_case_id(F.when(F.col("text").rlike(r"(?i)^[^A-Za-z0-9]*case id"), F.col("text")))
    starts = (F.col("source") == "digital") & (F.contains(F.lower("text"), F.lit(marker)) | F.coalesce(other != F.col("case_id"), F.lit(False)))
    cut = F.min(F.when(starts, F.col("line_ord"))).over(Window.partitionBy(*PAGE))
    return lines.withColumn("cut", cut).filter(F.col("cut").isNull() | (F.col("line_ord") < F.col("cut"))).drop("cut")


def pool_passes(lines: DataFrame) -> DataFrame:
    """One line for each text of a page, of all passes: the surest, the first of equals, in the order of first sight."""
    norm = T.normal_label(F.col("text"))
    return lines.groupBy(*PAGE, norm.alias("norm")).agg(F.max(F.struct("conf_bp", (-F.col("line_ord")).alias("o"), "text")).alias("b"), F.min("line_ord").alias("line_ord")).select(*PAGE, "line_ord", "b.text", "b.conf_bp")


def continued_reasons(lines: DataFrame) -> DataFrame:
    """case_id, page_index, line_ord, reason of each finding line, with the next two lines that are no rows, findings, footers or stamps.

    lines has skip, true for such lines, and is_finding.
    """
    ahead = Window.partitionBy(*PAGE).orderBy("line_ord").rowsBetween(1, 2)
    more = F.collect_list(F.when(~F.col("skip"), F.col("text"))).over(ahead)
    return lines.withColumn("more", more).filter("is_finding").select(*PAGE, "line_ord", F.array_join(F.concat(F.array("tail"), "more"), " ").alias("reason"))


def rows_of(spans: DataFrame, keys: tuple[str, ...] = PAGE, tolerance: float = 4.0) -> DataFrame:
    """spans (x, y) with row: spans join the row whose first one lies within tolerance of them, in order of height.

    The row's first span decides, so this is no gap between neighbours: the spans of a page, which are few, are folded in
    order within one row of the plan.
    """
    others = [c for c in spans.columns if c not in (*keys, "y", "x")]
    page = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("y", "x", *others))).alias("spans"))
    start = F.struct(F.lit(None).cast("double").alias("base"), F.lit(-1).alias("row"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, span: Column) -> Column:
        fresh = s["base"].isNull() | (F.abs(span["y"] - s["base"]) > tolerance)
        row = s["row"] + fresh.cast("int")
        return F.struct(F.when(fresh, span["y"].cast("double")).otherwise(s["base"]).alias("base"), row.alias("row"), F.concat(s["out"], F.array(row)).alias("out"))

    rows = F.aggregate("spans", start, step, lambda s: s["out"])
    each = page.select(*keys, F.explode(F.arrays_zip(F.col("spans").alias("span"), rows.alias("row"))).alias("e"))
    return each.select(*keys, "e.span.*", "e.row")


def assemble_lines(spans: DataFrame) -> DataFrame:
    """Lines of a page's visible spans: row by row, left to right; italic if any is, dark if all are."""
    dark = F.coalesce(F.array_min("color") < 0.45, F.lit(True))
    placed = rows_of(spans.withColumns({"y": (F.col("y0") + F.col("y1")) / 2, "x": F.col("x0"), "is_dark": dark}))
    words = F.array_sort(F.collect_list(F.struct("x", F.trim("text").alias("t"))))
    lines = placed.groupBy(*PAGE, "row").agg(words.alias("w"), F.max("italic").alias("italic"), F.min("is_dark").alias("dark"))
    return lines.select(*PAGE, F.col("row").alias("line_ord"), F.array_join(F.filter(F.transform("w", lambda x: x["t"]), lambda t: t != ""), " ").alias("text"), "italic", "dark").filter("text <> ''")


def words_to_lines(words: DataFrame) -> DataFrame:
    """Lines of OCR words by block, paragraph and line, left to right, with their mean confidence."""
    keys = (*PAGE, "block", "par", "line")
    inside = F.array_sort(F.collect_list(F.struct("x", "word_ord", "text")))
    return words.groupBy(*keys).agg(inside.alias("w"), F.avg("conf").alias("conf")).select(*keys, F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), "conf")


def islands(points: DataFrame, key: str, at: str, gap: float, least: int) -> DataFrame:
    """key, first, last, n of runs whose neighbours lie at most gap apart and that have least points or more."""
    order = Window.partitionBy(key).orderBy(at)
    starts = F.coalesce((F.col(at) - F.lag(at).over(order) > gap).cast("int"), F.lit(1))
    marked = points.withColumn("s", starts).withColumn("island", F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).drop("island")


def type_by_labels(labels: DataFrame) -> DataFrame:
    """case_id, page_index, doc_type of pages by their labels (case_id, page_index, label): a label counts once, twice if only one type has it.

    The best type needs three points and more than the next.
    """
    spark = labels.sparkSession
    kinds = spark.createDataFrame([(t, x, 2 if x in dims.TYPE_DISTINCTIVE[t] else 1) for t, xs in dims.TYPE_LABELS.items() for x in xs], "doc_type string, label string, points int")
    scored = labels.select(*PAGE, "label").distinct().join(F.broadcast(kinds), "label").groupBy(*PAGE, "doc_type").agg(F.sum("points").alias("points"))
    best = Window.partitionBy(*PAGE).orderBy(F.desc("points"), "doc_type")
    ranked = scored.withColumns({"rn": F.row_number().over(best), "next": F.lead("points").over(best)})
    return ranked.filter((F.col("rn") == 1) & (F.col("points") >= 3) & (F.col("points") > F.coalesce("next", F.lit(0)))).select(*PAGE, "doc_type", "points")


def header_types(lines: DataFrame) -> DataFrame:
    """case_id, page_index, doc_type, tier_x10 by the nearest header of a page's first lines; null and 50 without one.

    Each distinct line is compared with the headers once; of a page's lines that are equally near the first counts.
    """
    call = F.pandas_udf(lambda s: M.header_hits(s.tolist()), "doc_type string, tier_x10 int, share double")
    top = M.of_distinct(lines.filter(F.col("line_ord") < dims.HEADER_LINES).select(*PAGE, "line_ord", "text"), "text", "h", call("text"))
    first = F.slice(F.array_sort(F.collect_list(F.struct("line_ord", "text", "h"))), 1, dims.HEADER_LINES)
    near = F.transform(first, lambda x, i: F.when(x["h"]["doc_type"].isNotNull(), F.struct(x["h"]["share"].alias("share"), i.alias("i"), x["h"]["doc_type"].alias("doc_type"), x["h"]["tier_x10"].alias("tier_x10"))))
    return top.groupBy(*PAGE).agg(F.array_min(near).alias("b")).select(*PAGE, "b.doc_type", F.coalesce("b.tier_x10", F.lit(50)).alias("tier_x10"))


def anchored(lines: DataFrame) -> DataFrame:
    """lines with fld, label, value of those that begin with a label, matched once for each distinct text."""
    call = F.pandas_udf(lambda s: M.labels(s.tolist()), "fld string, label string, value string")
    return M.of_distinct(lines, "text", "a", call("text")).select("*", "a.fld", "a.label", "a.value").drop("a")


def label_runs(words: DataFrame, first: str, second: str, least: int = 60) -> DataFrame:
    """Places of a printed label of two words: neighbours on one row, left to right with a sane gap, both sure; one for each row of 24.

    words: case_id, page_index, word_ord, text, conf_bp, x, y, w, h.
    """
    order = Window.partitionBy(*PAGE).orderBy("word_ord")
    nxt = {k: F.lead(k).over(order) for k in ("text", "conf_bp", "x", "y", "w", "h")}
    both = words.withColumns({f"n_{k}": c for k, c in nxt.items()})
    fits = (
        (T.clean_token(F.col("text")) == first) & (T.clean_token(F.col("n_text")) == second) & (F.least("conf_bp", "n_conf_bp") >= least)
        & (F.least("w", "h", "n_w", "n_h") > 0) & (F.abs(F.col("y") - F.col("n_y")) <= F.greatest("h", "n_h"))
        & (F.col("n_x") > F.col("x") + F.col("w") * 0.5) & (F.col("n_x") < F.col("x") + F.col("w") + 3 * F.col("h"))
    )
    hit = both.filter(fits).select(*PAGE, F.floor((F.least("y", "n_y") + F.greatest(F.col("y") + F.col("h"), F.col("n_y") + F.col("n_h"))) / 24).alias("row"), F.least("conf_bp", "n_conf_bp").alias("conf_bp"), "x", "y", "word_ord")
    top = hit.groupBy(*PAGE, "row").agg(F.max(F.struct("conf_bp", (-F.col("word_ord")).alias("o"), "x", "y")).alias("t"))
    return top.select(*PAGE, "row", "t.conf_bp", "t.x", "t.y")


def digit_vote(reads: DataFrame, guarded: tuple[str, ...] = dims.REVOKED_SPONSORS) -> DataFrame:
    """case_id, sponsor_id: the majority at each of four places of a case's distinct reads (case_id, page_index, group).

    It abstains if reads come from one page, differ at over two places, tie or have a letter in the lead anywhere, or if a
    guarded id is among them or comes out. A case's distinct reads are a few four-letter groups.
    """
    digits = F.length(F.regexp_replace("group", "[^0-9]", ""))
    own = reads.filter((F.length("group") == 4) & (digits >= 2)).select("case_id", "page_index", "group").distinct()
    cases = own.groupBy("case_id").agg(F.countDistinct("page_index").alias("pages"), F.collect_set("group").alias("groups"))
    far = F.exists("groups", lambda g: F.exists("groups", lambda h: F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.lit(0), lambda n, i: n + F.when(F.substring(g, i, 1) != F.substring(h, i, 1), 1).otherwise(0)) > 2))
    bad = F.arrays_overlap(F.transform("groups", lambda g: F.concat(F.lit("SPN-"), g)), F.array(*map(F.lit, guarded)))
    good = cases.filter((F.col("pages") >= 2) & ~far & ~bad).select("case_id")
    each = own.join(good, "case_id").select("case_id", F.posexplode(F.split("group", "")).alias("pos", "char")).filter("char <> ''").groupBy("case_id", "pos", "char").agg(F.count(F.lit(1)).alias("n"))
    top = each.groupBy("case_id", "pos").agg(F.max(F.struct("n", "char")).alias("m"))
    lead = each.join(top.select("case_id", "pos", "m.n", F.col("m.char").alias("best")).withColumnRenamed("n", "most"), ["case_id", "pos"]).filter("n = most")
    placed = lead.groupBy("case_id", "pos").agg(F.count(F.lit(1)).alias("k"), F.max("best").alias("best"))
    voted = placed.groupBy("case_id").agg(F.max("k").alias("k"), F.concat(F.lit("SPN-"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "best"))), lambda x: x["best"]), "")).alias("sponsor_id"))
    return voted.filter((F.col("k") == 1) & F.col("sponsor_id").rlike("^SPN-[0-9]{4}$") & ~F.col("sponsor_id").isin(*guarded)).select("case_id", "sponsor_id")


def prose_values(letters: DataFrame) -> DataFrame:
    """case_id, page_index, fld, raw, conf_bp, source of attestation letters written as prose; lines are joined in order."""
    page = letters.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "text"))), lambda x: x["text"]), "\n").alias("t"), F.min("conf_bp").alias("conf_bp"), F.min((F.col("source") == "digital").cast("int")).alias("all_digital"))
    flat = F.replace(F.col("t"), F.lit("\n"), F.lit(" "))
    get = lambda s, p: F.nullif(F.regexp_extract(s, p, 1), F.lit(""))
    raws = {
        "sponsor_id": F.concat(F.lit("SPN-"), get(F.col("t"), r"\bSPN[-–—._ ]?([0-9]{4})\b")),
        "applicant_name": F.replace(get(F.col("t"), r"(?is)attests\s+that\s+(.+?)\s+is\s+expected"), F.lit("\n"), F.lit(" ")),
        "declared_purpose": get(flat, r"(?i)is\s+expected\s+on\s+Earth\s+for\s+(.+?)[.\n]"),
        "visa_class": get(F.col("t"), r"(?i)\bclass\s+(\S{3,12})\s+compliance"),
    }
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("fld"), c.alias("raw")) for f, c in raws.items()))).alias("r")
    found = page.filter(F.contains(F.lower("t"), F.lit("attest"))).select(*PAGE, "conf_bp", F.when(F.col("all_digital") == 1, "digital").otherwise("ocr").alias("source"), each)
    return found.select(*PAGE, "r.fld", "r.raw", "conf_bp", "source").filter("raw IS NOT NULL")


def visible_html(html: Column) -> Column:
    """An HTML page's text without what a reader cannot see: scripts, styles, comments, and tags."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"[ \t\n\r]+", " "))
