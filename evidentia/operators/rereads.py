"""Second looks at pages the first left open: which pages, views and strips are read again, what a reader's rows say, and when that counts.

Rows belong to a packet and a page, which are few; everything is keyed by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.config import EngineConfig
from evidentia.operators import pages as G
from evidentia.operators import policy as P
from evidentia.operators.pages import PAGE


def spans_of(traces: DataFrame) -> DataFrame:
    """Spans of a renderer's trace records: text from code points (chars), italic by the font's name; an empty colour is none."""
    hexes = F.array_join(F.transform("chars", lambda c: F.lpad(F.hex(c), 8, "0")), "")
    text = F.decode(F.unhex(hexes), "UTF-32")
    italic = F.coalesce(F.lower("font").rlike("oblique|italic"), F.lit(False))
    return traces.withColumns({"text": text, "color": F.when(F.size("color") > 0, F.col("color")), "italic": italic}).drop("chars")


def first_pages(pages: DataFrame, cap: int = dims.LOAD_PAGES) -> DataFrame:
    """Pages of a packet up to a stated number: the limit is the feature, as a packet with more is broken."""
    return pages.filter(F.col("page_index") < cap)


def load_pages(spans: DataFrame, images: DataFrame, cap: int = dims.LOAD_PAGES) -> tuple[DataFrame, DataFrame]:
    """Spans with kind and trusted, and the lines of digital pages.

    On a scanned page only footers are trusted, as no reader of the picture sees other text; a page without pictures is digital.
    """
    kinds = G.page_kinds(images)
    seen = G.hidden_reasons(first_pages(spans, cap)).join(kinds, list(PAGE), "left").withColumn("kind", F.coalesce("kind", F.lit("digital")))
    readable = (F.trim("text") != "") & (F.size("reasons") == 0)
    typed = seen.withColumn("trusted", F.coalesce(readable & ((F.col("kind") == "digital") | F.trim("text").rlike(dims.FOOTER_LINE)), F.lit(False)))
    return typed, G.assemble_lines(typed.filter("trusted AND kind = 'digital'"))


def readable(words: DataFrame) -> DataFrame:
    """case_id, page_index, content, readable: sure words besides footers, and whether two of them are words of a form."""
    text, sure = F.col("text"), F.col("conf") > 0.5
    content = sure & ~F.lower(text).isin(*dims.FOOTER_WORDS) & ~F.startswith(F.upper(text), F.lit("MIB-"))
    return words.groupBy(*PAGE).agg(F.count_if(content).alias("content"), (F.count_if(sure & text.rlike(dims.TEMPLATE_WORD)) >= 2).alias("readable"))


def candidate_pages(pages: DataFrame, scans: DataFrame, spans: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Scanned pages (kind, doc_type) of the wanted types that were rendered and do not name another packet."""
    wanted = pages.filter((F.col("kind") == "scan") & F.col("doc_type").isin(*types)).join(scans.select(*PAGE), list(PAGE), "left_semi")
    return G.drop_foreign(wanted, spans)


def escalation_views(pages: DataFrame, config: EngineConfig) -> DataFrame:
    """pages with view_ord, k, padded: quarter turns that further engines read.

    pages: upright, best_rot, probe_k, probe_confident. A sure probe gives one view, an unsure one its opposite too; without a
    probe a page that is not upright is read by its estimate and the opposite, if that switch is on, and else as it is.
    """
    opposite = lambda k: (k + 2) % 4
    as_is = F.array(F.lit(0))
    estimate = F.when(F.coalesce("best_rot", F.lit(0)) == 0, 1).otherwise(F.col("best_rot"))
    turned = F.array_sort(F.array(estimate, opposite(estimate)))
    plain = F.coalesce("upright", F.lit(False)) if config.active("escalation_views") else F.lit(True)
    ks, padded = F.when(plain, as_is).otherwise(turned), ~plain
    if config.active("rotation_probe"):
        probe = F.col("probe_k")
        sure = F.coalesce("probe_confident", F.lit(False))
        ks = F.when(probe.isNull(), ks).when(sure, F.array(probe)).otherwise(F.array(probe, opposite(probe)))
        padded = padded | probe.isNotNull()
    return pages.select("*", padded.alias("padded"), F.posexplode(ks).alias("view_ord", "k"))


def _strips(hits: DataFrame, keys: tuple[str, ...], most: int, ties: list[Column]) -> DataFrame:
    row = hits.groupBy(*keys, "row").agg(F.max(F.struct("conf_bp", (-F.col("hit_ord")).alias("o"), "x", "y")).alias("t"), F.min("hit_ord").alias("first_ord"))
    order = Window.partitionBy(*keys).orderBy(F.desc("t.conf_bp"), *ties)
    return row.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select(*keys, "row", "t.conf_bp", "t.x", "t.y", "rank")


def page_strips(hits: DataFrame, most: int = dims.PAGE_STRIPS) -> DataFrame:
    """The surest strips of a page over all fields, one for each row; of equals the row met first. hits: page, row, hit_ord, conf_bp, x, y."""
    return _strips(hits, PAGE, most, [F.col("first_ord")])


def field_strips(hits: DataFrame, most: int = dims.FIELD_STRIPS) -> DataFrame:
    """The surest strips of a field on a page, one for each row; of equals the lower one."""
    return _strips(hits, (*PAGE, "fld"), most, [F.desc("t.y"), F.desc("t.x"), F.col("first_ord")])


def greedy_decode(frames: Column, charset: str, blank: int = 0) -> Column:
    """text and conf of the likeliest class of each frame (array of arrays of scores), repeats and blanks left out.

    conf is the mean probability of the characters, 0 without any. Classes beyond charset have no character.
    """
    bind = lambda value, use: F.transform(F.array(value), use)[0]
    mass = lambda r, m: F.aggregate(r, F.lit(0.0), lambda s, v: s + F.exp(v - m))
    best = lambda r: bind(F.array_max(r), lambda m: F.struct((F.array_position(r, m) - 1).cast("int").alias("id"), (1.0 / mass(r, m)).alias("p")))
    fresh = lambda all_: F.filter(all_, lambda s, i: (s["id"] != blank) & ((i == 0) | (s["id"] != F.get(all_, i - 1)["id"])))
    char = lambda s: F.when((s["id"] > 0) & (s["id"] <= len(charset)), F.substring(F.lit(charset), s["id"], F.lit(1))).otherwise("")
    read = lambda kept: F.struct(
        F.array_join(F.transform(kept, char), "").alias("text"),
        F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda s, v: s + v["p"]) / F.size(kept)).otherwise(0.0).alias("conf"))
    return bind(bind(F.transform(frames, best), fresh), read)


def merged_rows(rows: DataFrame, scale: float = dims.READER_SCALE) -> DataFrame:
    """A line for each row of a page, left to right, with its mean confidence on the engines' common scale. rows: row, x, y, text, conf."""
    inside = F.array_sort(F.collect_list(F.struct("x", "y", "text")))  # a row of a page holds a few boxes
    return rows.groupBy(*PAGE, "row").agg(inside.alias("w"), F.avg("conf").alias("conf")).select(
        *PAGE, F.col("row").alias("line_ord"), F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), (F.col("conf") * scale).alias("conf"))


def reader_lines(boxes: DataFrame) -> DataFrame:
    """Lines of a reader's boxes (box_ord, x0, y0, x1, y1, text, conf), never of the first tier.

    Of boxes in one place the first counts, even if it is blank; text that names a sponsor is not taken from this reader.
    """
    spot = (F.bround((F.col("y0") + F.col("y1")) / 18).alias("sy"), F.bround(F.col("x0") / 30).alias("sx"))
    first = boxes.groupBy(*PAGE, *spot).agg(F.min(F.struct("box_ord", "x0", "y0", "y1", "text", "conf")).alias("b"))
    said = first.select(*PAGE, F.col("b.x0").cast("double").alias("x"), ((F.col("b.y0") + F.col("b.y1")) / 2).alias("y"), F.trim("b.text").alias("text"), "b.conf")
    kept = said.filter((F.col("text") != "") & ~F.col("text").rlike(dims.SPONSOR_TEXT))
    return merged_rows(G.rows_of(kept, PAGE, dims.ROW_REACH)).withColumn("tier1_ok", F.lit(False))


# ------------------------------------------------------------------ heads that settle one gap

_FAMILY = F.substring_index  # a view is named by its family, a hyphen and a number


def sole_gap(reads: DataFrame, fld: str) -> DataFrame:
    """case_id, fld, value, page_index, conf_bp of a field that one value fills on every page that two families of views agree about.

    reads: case_id, page_index, view, value, raw, conf_bp. A revoked sponsor counts only if each view shows it letter by letter.
    """
    verbatim = F.contains("raw", F.col("value")) | ~F.col("value").isin(*dims.REVOKED_SPONSORS)
    page = reads.filter("value IS NOT NULL").groupBy(*PAGE).agg(
        F.min("value").alias("value"), F.max("value").alias("v1"), F.countDistinct(_FAMILY("view", "-", 1)).alias("families"),
        F.min("conf_bp").alias("conf_bp"), F.min(F.coalesce(verbatim, F.lit(False)).cast("int")).alias("verbatim"))
    agreed = page.filter((F.col("value") == F.col("v1")) & (F.col("families") >= 2) & (F.col("verbatim") == 1))
    case = agreed.groupBy("case_id").agg(F.min("value").alias("value"), F.max("value").alias("v1"), F.min(F.struct("page_index", "conf_bp")).alias("t"))
    return case.filter(F.col("value") == F.col("v1")).select("case_id", F.lit(fld).alias("fld"), "value", "t.page_index", "t.conf_bp")


def arrival_head(reads: DataFrame, anchors: DataFrame) -> DataFrame:
    """case_id, fld, value, page_index, conf_bp where two families of views of the only intake page read the date already known.

    reads as for sole_gap, with poisoned for views that show the date as unreadable, which settles nothing; anchors: case_id, anchor.
    """
    case = reads.groupBy("case_id").agg(
        F.countDistinct("page_index").alias("pages"), F.max(F.col("poisoned").cast("int")).alias("poisoned"), F.min("page_index").alias("page_index"),
        F.min("value").alias("value"), F.max("value").alias("v1"), F.min(F.when(F.col("value").isNotNull(), F.col("conf_bp"))).alias("conf_bp"),
        F.countDistinct(F.when(F.col("value").isNotNull(), _FAMILY("view", "-", 1))).alias("families"))
    sure = case.filter((F.col("pages") == 1) & (F.coalesce("poisoned", F.lit(0)) == 0) & (F.col("value") == F.col("v1")) & (F.col("families") >= 2))
    return sure.join(anchors, "case_id").filter(F.col("value") == F.col("anchor")).select("case_id", F.lit("arrival_on_intake").alias("fld"), "value", "page_index", "conf_bp")


def discharged(first: DataFrame, fills: DataFrame, path_stats: DataFrame, config: EngineConfig) -> DataFrame:
    """first (decided evidence) with the gap of its path filled where a head found it, and those packets decided again, at most 0.90 sure.

    fills: case_id, fld, value, conf_bp, of any heads; only the head that owns a packet's path counts, and only if switched on.
    """
    owner = [(path, fld) for path, (switch, fld) in dims.HEADS.items() if config.active(switch)]
    if not owner:
        return first
    gap = F.coalesce(*(F.when(F.col("path") == p, F.lit(f)) for p, f in owner))
    own = fills.select("case_id", F.col("fld").alias("gap"), F.col("value").alias("fill"), F.col("conf_bp").alias("fill_conf"))
    both = first.withColumn("gap", gap).join(own, ["case_id", "gap"], "left").withColumn("fired", F.col("fill").isNotNull())
    hit = lambda f: F.col("fired") & (F.col("gap") == f)
    new = {"arrival_on_intake": F.col("arrival_on_intake") | F.coalesce(hit("arrival_on_intake"), F.lit(False))}
    for f in ("fee_status", "sponsor_id", "visa_class"):
        new |= {f"{f}_value": F.when(hit(f), F.col("fill")).otherwise(F.col(f"{f}_value")), f"{f}_known": F.when(hit(f), True).otherwise(F.col(f"{f}_known")),
                f"{f}_conf_bp": F.when(hit(f), F.col("fill_conf")).otherwise(F.col(f"{f}_conf_bp"))}
    old = ("policy_label", "path", "adjudication", "confidence")
    kept = both.withColumns(new).withColumnsRenamed({c: f"old_{c}" for c in old}).drop("gap", "fill", "fill_conf")
    again = P.decide(P.cascade(kept), path_stats).withColumn("confidence", F.least("confidence", F.lit(dims.HEAD_CEILING)))
    return again.withColumns({c: F.when(F.col("fired"), F.col(c)).otherwise(F.col(f"old_{c}")) for c in old}).select(*first.columns)
