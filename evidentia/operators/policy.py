"""The rule cascade, the choice by expected value, and the emitted row: row-local expressions over reconciled evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia import dims


def known(fld: str) -> Column:
    return F.when(F.col(f"{fld}_known"), F.col(f"{fld}_value"))


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def iso_day(value: Column) -> Column:
    return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value.try_cast("date"))


def is_stale(day: Column) -> Column:
    return is_true(F.datediff(F.lit(dims.RECEIPT_DAY).cast("date"), day) > dims.STALE_DAYS)


def _any(flags: str, names) -> Column:
    return F.arrays_overlap(F.col(flags), F.array(*map(F.lit, names)))


def arrival() -> Column:
    return F.when(F.col("arrival_on_intake"), iso_day(F.col("arrival_date_value")))


def cascade(evidence: DataFrame) -> DataFrame:
    """evidence with policy_label and path: the first rule that holds."""
    visa, world, fee, sponsor = (known(f) for f in ("visa_class", "home_world", "fee_status", "sponsor_id"))
    under_rules = visa.isNotNull() & (visa != "DIP-1")
    rules = [
        (F.col("finding_conflict"), "NEEDS_REVIEW", F.lit("N0_note_conflict")),
        (F.col("finding_conf_bp") >= dims.FINDING_LEAST, None, F.concat(F.lit("N0_note_"), F.lower("finding_label"))),
        (_any("flags", dims.DISQUALIFYING_FLAGS), "DENIED", F.lit("R1_disqualifying_flag")),
        (world.isin(*dims.HARD_EMBARGO), "DENIED", F.lit("R2_hard_embargo_world")),
        (fee == "unpaid", "DENIED", F.lit("R3_fee_unpaid")),
        (under_rules & sponsor.isin(*dims.REVOKED_SPONSORS), "DENIED", F.lit("R4_revoked_sponsor")),
        (under_rules & world.isin(*dims.SOFT_EMBARGO), "DENIED", F.lit("R5_soft_embargo_world")),
        (under_rules & is_stale(arrival()), "DENIED", F.lit("R6_stale_arrival")),
        (visa == "TRANSIT-7", "DENIED", F.lit("R7_transit_visa")),
        (fee == "unknown", "NEEDS_REVIEW", F.lit("R8_fee_unknown")),
        (fee.isNull(), "NEEDS_REVIEW", F.lit("R8_fee_unread")),
        (arrival().isNull(), "NEEDS_REVIEW", F.lit("R9_arrival_not_visible")),
        (_any("flags", dims.REVIEW_FLAGS), "NEEDS_REVIEW", F.lit("R10_review_flags")),
        (~F.col("flags_known"), "NEEDS_REVIEW", F.lit("R12_flags_unread")),
        (visa.isNull(), "NEEDS_REVIEW", F.lit("R12_visa_unread")),
        (world.isNull(), "NEEDS_REVIEW", F.lit("R12_world_unread")),
        ((visa != "DIP-1") & sponsor.isNull(), "NEEDS_REVIEW", F.lit("R12_sponsor_unread")),
    ]
    outcome = F.struct(F.lit("APPROVED").alias("label"), F.lit("R11_default_approve").alias("path"))
    for condition, label, path in reversed(rules):
        own = F.lit(label) if label else F.col("finding_label")
        outcome = F.when(is_true(condition), F.struct(own.alias("label"), path.alias("path"))).otherwise(outcome)
    # named by an aggregation-free step, so the struct is computed once
    return evidence.withColumn("outcome", outcome).select("*", F.col("outcome.label").alias("policy_label"), F.col("outcome.path").alias("path")).drop("outcome")


def _deny_signal() -> Column:
    """What is read that speaks against an approval."""
    visa, world, fee, sponsor = (known(f) for f in ("visa_class", "home_world", "fee_status", "sponsor_id"))
    spared = is_true(visa == "DIP-1")
    outright = (F.size("flags") > 0) | is_true(fee.isin("unpaid", "unknown")) | is_true(world.isin(*dims.HARD_EMBARGO)) | is_true(visa == "TRANSIT-7")
    return outright | (~spared & (is_true(sponsor.isin(*dims.REVOKED_SPONSORS)) | is_true(world.isin(*dims.SOFT_EMBARGO)) | is_stale(arrival())))


def template_rescue(decided: DataFrame) -> DataFrame:
    """decided with policy_label and path of cases that a note's reason alone settles where too little was read."""
    visa, fee = known("visa_class"), known("fee_status")
    label, template = F.col("template_label"), F.col("template")
    contradicted = (
        F.when(label == "APPROVED", _deny_signal())
        .when((label == "DENIED") & (template == "Mandatory fee unpaid."), is_true(fee.isin("paid", "waived")))
        .when((label == "DENIED") & (template == "Transit class cannot authorize declared work."), is_true(visa != "TRANSIT-7"))
        .otherwise(False)
    )
    rescued = F.col("path").isin(*dims.UNDERDETERMINED) & is_true(F.col("template_conf_bp") >= dims.FINDING_LEAST) & ~contradicted
    return decided.withColumns({
        "policy_label": F.when(rescued, label).otherwise(F.col("policy_label")),
        "path": F.when(rescued, F.concat(F.lit("N1_reason_"), F.lower(label))).otherwise(F.col("path")),
    })


def stamp_eligible(decided: DataFrame) -> DataFrame:
    """decided with stamp_eligible: too little was read, and nothing read speaks against an approval."""
    return decided.withColumn("stamp_eligible", F.col("path").isin(*dims.UNDERDETERMINED) & ~_deny_signal())


def unread_inputs(evidence: DataFrame) -> DataFrame:
    """evidence with unread: the inputs of the decision that are still unread, in the order of the gates."""
    missing = lambda f: F.col(f"{f}_value").isNull()
    gates = [
        (missing("fee_status"), "fee_status"), (~F.col("flags_known"), "risk_flags"), (~F.col("arrival_on_intake"), "arrival_date"),
        (missing("visa_class"), "visa_class"), (missing("home_world"), "home_world"),
        (F.coalesce(F.col("visa_class_value") != "DIP-1", F.lit(True)) & missing("sponsor_id"), "sponsor_id"),
    ]
    return evidence.withColumn("unread", F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in gates))))


def decide(decided: DataFrame, path_stats: DataFrame) -> DataFrame:
    """decided (policy_label, path) with adjudication and confidence.

    The posterior gives the policy's label the path's accuracy and splits the rest by the path's errors; the label of most
    expected points is chosen, the first of equals, unless the path is held. path_stats has a few dozen rows.
    """
    stats = decided.join(F.broadcast(path_stats), "path", "left")
    default = dict(zip(("accuracy", "share_a", "share_d", "share_r", "pinned"), dims.OTHER_PATH, strict=True))
    stats = stats.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in default.items()})
    share = {c: F.when(F.col("policy_label") == c, 0.0).otherwise(F.col(s)) for c, s in zip(dims.LABELS, ("share_a", "share_d", "share_r"), strict=True)}
    total = share["APPROVED"] + share["DENIED"] + share["NEEDS_REVIEW"]
    listed = {c: (F.col(s) > 0) for c, s in zip(dims.LABELS, ("share_a", "share_d", "share_r"), strict=True)}
    rest = {c: F.when(total > 0, (1.0 - F.col("accuracy")) * (share[c] / total)).when(listed[c] & (F.col("policy_label") != c), (1.0 - F.col("accuracy")) * 0.5).otherwise(0.0) for c in dims.LABELS}
    p = {c: F.when(F.col("policy_label") == c, F.col("accuracy")).otherwise(0.0) + rest[c] for c in dims.LABELS}
    stats = stats.withColumns({f"p{i}": p[c] for i, c in enumerate(dims.LABELS)})
    pa, pd, pn = (F.col(f"p{i}") for i in range(3))
    points = (8 * pa - 4 * pd + pn, 8 * pd + pn, 2 * (pa + pd) + 8 * pn)
    stats = stats.withColumns({f"e{i}": e for i, e in enumerate(points)})
    a, d, n = (F.col(f"e{i}") for i in range(3))
    choice = F.when(F.col("pinned"), 2).when((a >= d) & (a >= n), 0).when(d >= n, 1).otherwise(2)
    stats = stats.withColumn("choice", choice)
    chance = F.when(F.col("choice") == 0, pa).when(F.col("choice") == 1, pd).otherwise(pn)
    label = F.get(F.array(*map(F.lit, dims.LABELS)), F.col("choice"))
    out = stats.withColumns({"adjudication": label, "confidence": F.least(F.greatest(chance, F.lit(dims.CONF_FLOOR)), F.lit(dims.CONF_CEIL))})
    return out.select(*decided.columns, "adjudication", "confidence")


def policy_label_of(path: Column) -> Column:
    """The label that a stored path stands for."""
    tail = F.regexp_extract(path, "^N[01]_(?:note|reason)_(approved|denied|needs_review)$", 1)
    return (
        F.when(path == "N0_note_conflict", "NEEDS_REVIEW").when(tail != "", F.upper(tail))
        .when(path.rlike("^R[1-7]_"), "DENIED").when(path == "R11_default_approve", "APPROVED").otherwise("NEEDS_REVIEW")
    )


def build_row(decided: DataFrame) -> DataFrame:
    """The twelve emitted columns: defaults for what is unread, patterns enforced, and no value in an approved row that policy would deny."""
    d = dims.DEFAULTS
    value = lambda f: F.coalesce(F.nullif(F.col(f"{f}_value"), F.lit("")), F.lit(d[f]))
    out = decided.select(
        "case_id", *(value(f).alias(f) for f in dims.FIELDS),
        F.when(F.size("flags") > 0, F.array_join(F.array_sort("flags"), "|")).otherwise("none").alias("risk_flags"),
        F.when(F.col("adjudication").isin(*dims.LABELS), F.col("adjudication")).otherwise("NEEDS_REVIEW").alias("adjudication"),
        F.bround(F.least(F.greatest("confidence", F.lit(0.0)), F.lit(1.0)), 4).alias("confidence"))
    out = out.withColumns({
        "fee_status": F.when(F.col("fee_status").isin(*dims.FEES), F.col("fee_status")).otherwise("unknown"),
        "sponsor_id": F.when(F.col("sponsor_id").rlike("^SPN-[0-9]{4}$"), F.col("sponsor_id")).otherwise(d["sponsor_id"]),
        "arrival_date": F.when(F.col("arrival_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.col("arrival_date")).otherwise(d["arrival_date"]),
    })
    return suppress_deny_triggers(out)


def suppress_deny_triggers(rows: DataFrame) -> DataFrame:
    """rows in which approved ones lose values that deny; the steps' order matters, as a replaced visa no longer spares."""
    d, ok = dims.DEFAULTS, F.col("adjudication") == "APPROVED"
    swap = lambda c, bad: F.when(ok & bad, F.lit(d[c])).otherwise(F.col(c))
    rows = rows.withColumns({
        "risk_flags": F.when(ok, "none").otherwise(F.col("risk_flags")),
        "home_world": swap("home_world", F.col("home_world").isin(*dims.HARD_EMBARGO)),
        "fee_status": swap("fee_status", F.col("fee_status").isin("unpaid", "unknown")),
        "visa_class": swap("visa_class", F.col("visa_class") == "TRANSIT-7"),
    })
    ruled = F.col("visa_class") != "DIP-1"
    day = iso_day(F.col("arrival_date"))
    return rows.withColumns({
        "sponsor_id": swap("sponsor_id", ruled & F.col("sponsor_id").isin(*dims.REVOKED_SPONSORS)),
        "home_world": swap("home_world", ruled & F.col("home_world").isin(*dims.SOFT_EMBARGO)),
        "arrival_date": swap("arrival_date", ruled & (day.isNull() | is_stale(day))),
    })


def fallback_rows(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """rows, and for each of cases without one the row of a failed case."""
    gone = cases.join(rows.select("case_id"), "case_id", "left_anti")
    accuracy = dims.PATHS["FALLBACK_error"][0]
    default = gone.select("case_id", *(F.lit(v).alias(k) for k, v in dims.DEFAULTS.items()), F.lit("none").alias("risk_flags"), F.lit("NEEDS_REVIEW").alias("adjudication"), F.lit(accuracy).alias("confidence"))
    return rows.unionByName(default)


def restore_guard(before: DataFrame, after: DataFrame) -> DataFrame:
    """after, but fields that were known before keep their value, confidence and knownness: a later pass may only fill."""
    held = [f"{f}_{k}" for f in dims.FIELDS for k in ("value", "conf_bp", "known")]
    old = before.select("case_id", *(F.col(c).alias(f"old_{c}") for c in held))
    joined = after.join(old, "case_id", "left")
    was = lambda c: is_true(F.col(f"old_{c.rsplit('_conf_bp', 1)[0].removesuffix('_value').removesuffix('_known')}_known"))
    return joined.select(*(F.when(was(c), F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) if c in held else F.col(c) for c in after.columns))
