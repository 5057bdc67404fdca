"""Reconciliation of field candidates by weighted votes.

Weights are whole numbers (confidence in percent times 100 plus the tier's bonus), so sums do not depend on their order. Ties
go to the value seen first. A packet's rows are few and never spread over packets, so rows are dealt out once by packet and every
later step stays in place; nothing is collected in lists but the flags of a packet, of which there are eight kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia import dims


def bonus(fld: Column, tier: Column) -> Column:
    """The tier's bonus in percent, by the field's own order of trust."""
    def table(values: dict[int, int]) -> Column:
        out = F.lit(dims.OTHER_BONUS)
        for t, b in values.items():
            out = F.when(tier == t, b).otherwise(out)
        return out

    out = table(dims.TIER_BONUS)
    for name, values in dims.FIELD_BONUS.items():
        out = F.when(fld == name, table(values)).otherwise(out)
    return out


def weighted(candidates: DataFrame) -> DataFrame:
    """candidates with a value, and weight, a whole number."""
    weight = (F.col("conf_bp") * (100 + bonus(F.col("fld"), F.col("tier_x10")))).cast("long")
    return candidates.filter(F.col("value").isNotNull()).withColumn("weight", weight)


#: Ordinals of a packet's candidates are below this.
_ORDINALS = 1 << 40


def _supporter() -> Column:
    """Confidence, ordinal and kind of a supporter as one number; the surest is the largest, the first of equals."""
    return (F.col("conf_bp") * _ORDINALS + (_ORDINALS - 1 - F.col("cand_ord"))) * 2 + (F.col("source") == "digital").cast("long")


def vote(pool: DataFrame, keys: tuple[str, ...] = ("case_id", "fld")) -> DataFrame:
    """keys, value, score, conf_bp, source: the value of the largest sum of weights, and its surest supporter, the first of equals.

    The supporter's confidence, ordinal and kind are one number, so the sums are hashed, not sorted. Where pool is dealt by
    packet already, neither aggregation moves rows.
    """
    sums = pool.groupBy(*keys, "value").agg(F.sum("weight").alias("score"), F.min("cand_ord").alias("first_ord"), F.max(_supporter()).alias("best"))
    top = sums.groupBy(*keys).agg(F.max(F.struct("score", (-F.col("first_ord")).alias("o"), "value", "best")).alias("t"))
    best = F.col("t.best")
    return top.select(*keys, "t.value", "t.score", F.floor(best / (2 * _ORDINALS)).alias("conf_bp"), F.when(best % 2 == 1, "digital").otherwise("ocr").alias("source"))


def corrections(pool: DataFrame) -> DataFrame:
    """The heaviest correction of each packet and field, the first of equals; it overrides every vote."""
    own = pool.filter(F.col("tier_x10") == dims.CORRECTION_TIER)
    top = own.groupBy("case_id", "fld").agg(F.max(F.struct("weight", (-F.col("cand_ord")).alias("o"), "value", "conf_bp", "source")).alias("t"))
    return top.select("case_id", "fld", "t.value", "t.conf_bp", "t.source")


def digital_first(pool: DataFrame) -> DataFrame:
    """pool without what is read by OCR, for fields and packets in which text is read digitally; names likewise without fragments."""
    own = Window.partitionBy("case_id", "fld")
    full = F.size(F.split(F.trim("value"), r"\s+")) >= 2
    marked = pool.withColumns({"has_digital": F.max((F.col("source") == "digital").cast("int")).over(own), "has_full": F.max(full.cast("int")).over(own)})
    ocr_beaten = F.col("fld").isin(*dims.DIGITAL_FIRST) & (F.col("has_digital") == 1) & (F.col("source") != "digital")
    fragment = (F.col("fld") == "applicant_name") & (F.col("has_full") == 1) & ~full
    return marked.filter(~ocr_beaten & ~fragment).drop("has_digital", "has_full")


def parse_amount(raw: Column) -> Column:
    """Whole dollars of an amount row; letters that stand for digits are repaired."""
    digits = F.translate(F.regexp_extract(raw, r"\$?\s*([0-9oOlI]{1,6})(?:[.,][0-9oO]{2})?\b", 1), dims.DIGIT_FROM, dims.DIGIT_TO)
    return F.when(digits.rlike("^[0-9]+$"), digits.cast("int"))


def receipt_verdict(status: Column, amount: Column, waiver: Column) -> Column:
    """The fee status that a receipt's status, amount and waiver rows amount to; null if they leave it open."""
    present = F.upper(waiver).contains("WAIVER")
    return (
        F.when(amount == 809, "paid")
        .when((amount == 0) & F.coalesce(present, F.lit(False)), "waived")
        .when((amount == 0) & F.coalesce(status == "unpaid", F.lit(False)), "unpaid")
        .when(amount == 0, "unknown")
        .when(F.coalesce((status == "waived") & ~present, F.lit(False)), "unknown")
        .otherwise(status)
    )


def fee_pages(fee_rows: DataFrame) -> DataFrame:
    """case_id, page_index, first_ord, verdict, conf_bp, weight of each receipt page with a verdict.

    fee_rows has a row's status, amount_raw and waiver; a page keeps of each the readable one of highest confidence, the
    first of equals. Status carries the weight, else the amount, else it is one half.
    """
    def kept(name: str, parsed: bool) -> Column:
        known = F.col(name).isNotNull().cast("int") if parsed else F.lit(0)
        return F.max(F.when(F.col(f"has_{name}"), F.struct(known.alias("known"), "conf_bp", (-F.col("cand_ord")).alias("o"), F.col(name).alias("x"), "tier_x10"))).alias(name)

    marked = fee_rows.withColumns({f"has_{n}": F.col(n).isNotNull() for n in ("status", "amount_raw", "waiver")})
    page = marked.groupBy("case_id", "page_index").agg(kept("status", True), kept("amount_raw", False), kept("waiver", True), F.min("cand_ord").alias("first_ord"))
    verdict = receipt_verdict(F.col("status.x"), parse_amount(F.col("amount_raw.x")), F.col("waiver.x"))
    anchor = F.coalesce("status", "amount_raw")
    tier = bonus(F.lit("fee_status"), anchor["tier_x10"])
    return page.select(
        "case_id", "page_index", "first_ord", verdict.alias("verdict"), F.coalesce(anchor["conf_bp"], F.lit(50)).alias("conf_bp"),
        F.coalesce(anchor["conf_bp"] * (100 + tier), F.lit(5000)).cast("long").alias("weight"),
    ).filter(F.col("verdict").isNotNull())


def resolve_fee(fee_rows: DataFrame) -> DataFrame:
    """case_id, value, score, conf_bp: the verdict of the largest weight over a packet's receipt pages."""
    sums = fee_pages(fee_rows).groupBy("case_id", "verdict").agg(F.sum("weight").alias("score"), F.min("first_ord").alias("o"), F.max("conf_bp").alias("conf_bp"))
    top = sums.groupBy("case_id").agg(F.max(F.struct("score", (-F.col("o")).alias("o"), "verdict", "conf_bp")).alias("t"))
    return top.select("case_id", F.col("t.verdict").alias("value"), "t.score", "t.conf_bp")


def flags_union(flag_candidates: DataFrame) -> DataFrame:
    """case_id, flags (sorted), flags_known; a read of no flags counts as known if it is digital or sure enough."""
    ok = flag_candidates.filter(F.col("parsed_ok") & (F.col("conf_bp") >= dims.FLAG_LEAST))
    named = F.filter(F.split("flags_text", ","), lambda x: x != "")
    known = (F.size(named) > 0) | (F.col("source") == "digital") | (F.col("conf_bp") >= dims.NONE_LEAST)
    return ok.groupBy("case_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(named)))).alias("flags"), F.max(known).alias("flags_known"))


def findings_of(findings: DataFrame) -> DataFrame:
    """case_id, finding_label, finding_conf_bp, finding_conflict, template_label, template, template_conf_bp.

    Findings of differing labels conflict; otherwise the surest counts, the first of equals. Findings by template alone are
    kept apart, and cancel each other if they differ.
    """
    best = lambda c, *more: F.max(F.when(c, F.struct("conf_bp", (-F.col("find_ord")).alias("o"), "label", *more)))
    own, other = ~F.col("template_only"), F.col("template_only")
    out = findings.groupBy("case_id").agg(
        best(own).alias("f"), best(other, "template").alias("t"),
        F.min(F.when(own, F.col("label"))).alias("f0"), F.max(F.when(own, F.col("label"))).alias("f1"),
        F.min(F.when(other, F.col("label"))).alias("t0"), F.max(F.when(other, F.col("label"))).alias("t1"))
    clash, one = F.coalesce(F.col("f0") != F.col("f1"), F.lit(False)), F.coalesce(F.col("t0") == F.col("t1"), F.lit(False))
    return out.select(
        "case_id", F.when(~clash, F.col("f.label")).alias("finding_label"), F.when(~clash, F.col("f.conf_bp")).alias("finding_conf_bp"), clash.alias("finding_conflict"),
        F.when(one, F.col("t.label")).alias("template_label"), F.when(one, F.col("t.template")).alias("template"), F.when(one, F.col("t.conf_bp")).alias("template_conf_bp"))


def settle(contested: DataFrame) -> DataFrame:
    """case_id, fld, value, conf_bp, known: each field's vote, and for names the digital reading where it outdoes the vote.

    Labelled rows count before prose; digital rows of one value win if there are two or more, and one alone wins over a
    voted value that differs from it by at most 0.15 of its length. A value is known if its surest supporter is digital
    or sure enough. One pass: what the choice needs is summed with the votes.
    """
    from evidentia.functions.fuzzy import weighted_distance

    digital = F.col("source") == "digital"
    labelled = digital & F.col("tier_x10").isin(20, 30, 50)
    sums = contested.groupBy("case_id", "fld", "value").agg(F.sum("weight").alias("score"), F.min("cand_ord").alias("first_ord"), F.max(_supporter()).alias("best"), F.count_if(labelled).alias("n_lab"), F.count_if(digital).alias("n_dig"))
    of = lambda n, c: F.when(F.col(n) > 0, F.col(c))
    single = [f(of(n, c)).alias(f"{k}{n}") for n in ("n_lab", "n_dig") for k, f, c in (("lo_", F.min, "value"), ("hi_", F.max, "value"), ("best_", F.max, "best"))]
    top = sums.groupBy("case_id", "fld").agg(F.max(F.struct("score", (-F.col("first_ord")).alias("o"), "value", "best")).alias("t"), F.sum("n_lab").alias("labelled"), F.sum("n_dig").alias("digital"), *single)
    pick = lambda k: F.when(F.col("labelled") > 0, F.col(f"{k}n_lab")).otherwise(F.col(f"{k}n_dig"))
    rival = F.when((F.col("fld") == "applicant_name") & (pick("lo_") == pick("hi_")) & (pick("lo_") != F.col("t.value")), pick("lo_"))
    rows = top.withColumns({"rival": rival, "rivals": F.when(F.col("labelled") > 0, F.col("labelled")).otherwise(F.col("digital")), "rival_best": pick("best_")})
    lone = F.when(F.col("rivals") == 1, F.lower("rival"))  # null for all others, for which nothing is computed
    rows = rows.withColumn("far", weighted_distance(lone, F.lower("t.value")))
    wins = F.coalesce(F.col("rival").isNotNull() & ((F.col("rivals") >= 2) | (F.col("far") <= 0.15 * F.greatest(F.length("rival"), F.length("t.value")))), F.lit(False))
    best = F.when(wins, F.col("rival_best")).otherwise(F.col("t.best"))
    conf = F.floor(best / (2 * _ORDINALS))
    return rows.select("case_id", "fld", F.when(wins, F.col("rival")).otherwise(F.col("t.value")).alias("value"), conf.alias("conf_bp"), ((best % 2 == 1) | (conf >= dims.KNOWN_LEAST)).alias("known"))


def reconcile(candidates: DataFrame, fee_rows: DataFrame, flag_candidates: DataFrame, findings: DataFrame, cases: DataFrame) -> DataFrame:
    """One wide row for each packet of cases: value, conf_bp and known of each field, flags, finding, template, arrival_on_intake."""
    # dealt out once by packet; every aggregation, window and join below asks for no other dealing
    candidates, fee_rows, flag_candidates, findings, cases = (t.repartition("case_id") for t in (candidates, fee_rows, flag_candidates, findings, cases))
    pool = weighted(candidates)
    overriding = corrections(pool).withColumn("known", F.lit(True))
    voted = settle(digital_first(pool.filter(F.col("fld") != "fee_status")))
    fees = resolve_fee(fee_rows).select("case_id", F.lit("fee_status").alias("fld"), "value", "conf_bp", F.lit(True).alias("known"))
    names = ["case_id", "fld", "value", "conf_bp", "known"]
    ruled = overriding.select(*names, F.lit(1).alias("rank")).unionByName(voted.unionByName(fees).select(*names, F.lit(0).alias("rank")))
    arrivals = pool.filter(F.col("fld") == "arrival_date").groupBy("case_id").agg(F.max(F.col("tier_x10").isin(dims.CORRECTION_TIER, dims.INTAKE_TIER)).alias("arrival_on_intake"))
    # the pivot and the choice of corrections over votes are one aggregation
    wide = ruled.groupBy("case_id").agg(*(F.max(F.when(F.col("fld") == f, F.struct("rank", "value", "conf_bp", "known"))).alias(f) for f in dims.FIELDS))
    wide = cases.join(wide, "case_id", "left").join(arrivals, "case_id", "left").join(flags_union(flag_candidates), "case_id", "left").join(findings_of(findings), "case_id", "left")
    cols = [c for f in dims.FIELDS for c in (F.col(f"{f}.value").alias(f"{f}_value"), F.coalesce(f"{f}.known", F.lit(False)).alias(f"{f}_known"), F.coalesce(f"{f}.conf_bp", F.lit(0)).alias(f"{f}_conf_bp"))]
    off = F.lit(False)
    return wide.select(
        "case_id", *cols, F.coalesce("flags", F.array().cast("array<string>")).alias("flags"), F.coalesce("flags_known", off).alias("flags_known"),
        "finding_label", "finding_conf_bp", F.coalesce("finding_conflict", off).alias("finding_conflict"), "template_label", "template", "template_conf_bp",
        F.coalesce("arrival_on_intake", off).alias("arrival_on_intake"))
