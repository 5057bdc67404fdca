"""The laboratory: damage grids and their tallies, ranked repairs, welds of cut rows, and reports that see annotations last."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia import dims


def degradation_grid(spark: SparkSession) -> DataFrame:
    """jpeg, blur, skew, noise: every combination of the closed lists of damage, 48 rows."""
    rows = spark.range(1).select()
    for name, values in dims.GRID.items():
        rows = rows.select("*", F.explode(F.array(*(F.lit(v) for v in values))).alias(name))
    return rows


def tally(reads: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """ok, wrong, abstain_genuine, abstain_probe, and least and fifth percentile of what was accepted rightly.

    reads: expected (null for a probe that means nothing), value (null where the reader abstains), score, margin. Percentiles are
    the entry at a twentieth of the sorted list, rounded down, found by rank and not by collecting the list.
    """
    ok = F.col("value").isNotNull() & F.col("expected").isNotNull() & (F.col("value") == F.col("expected"))
    marked = reads.withColumn("ok", ok)
    counts = marked.groupBy(*keys).agg(
        F.count_if("ok").alias("ok"), F.count_if(F.col("value").isNotNull() & ~F.col("ok")).alias("wrong"),
        F.count_if(F.col("value").isNull() & F.col("expected").isNotNull()).alias("abstain_genuine"),
        F.count_if(F.col("value").isNull() & F.col("expected").isNull()).alias("abstain_probe"),
        *(F.min(F.when(F.col("ok"), F.col(c))).alias(f"{c}_min") for c in ("score", "margin")))
    out = counts.withColumns({k: F.col(k) for k in keys}) if keys else counts.withColumn("whole", F.lit(1))
    on = list(keys) or ["whole"]
    right = marked.filter("ok") if keys else marked.filter("ok").withColumn("whole", F.lit(1))
    for c in ("score", "margin"):
        each = right.groupBy(*on, c).agg(F.count(F.lit(1)).alias("n"))  # equal values together before they are ranked
        upto = F.sum("n").over(Window.partitionBy(*on).orderBy(c).rowsBetween(Window.unboundedPreceding, 0))
        placed = each.withColumns({"upto": upto, "total": F.sum("n").over(Window.partitionBy(*on))})
        fifth = placed.filter(F.col("upto") > F.floor(F.col("total") / 20)).groupBy(*on).agg(F.min(c).alias(f"{c}_p5"))
        out = out.join(fifth, on, "left")
    return out.drop("whole")


def ranked(candidates: DataFrame, keys: tuple[str, ...], signature: tuple[str, ...], gain: str, ties: list[Column], most: int) -> DataFrame:
    """The best candidate of each signature, by gain, and of these the best few of each key, with their rank."""
    own = Window.partitionBy(*keys, *signature).orderBy(F.desc(gain), *ties)
    distinct = candidates.withColumn("_own", F.row_number().over(own)).filter("_own = 1").drop("_own")
    order = Window.partitionBy(*keys).orderBy(F.desc(gain), *ties)
    return distinct.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def least(rows: DataFrame, keys: tuple[str, ...], objective: tuple[str, ...]) -> DataFrame:
    """The row of each key whose objective is least, term by term; rows equal in it are told apart by their other columns."""
    rest = [c for c in rows.columns if c not in (*keys, *objective)]
    return rows.groupBy(*keys).agg(F.min(F.struct(*objective, *rest)).alias("t")).select(*keys, "t.*")


def weld_bands(ink: np.ndarray) -> list[tuple[int, int]]:
    """Top and bottom of a page's inked bands, with four rows of margin; bands nearer than eight rows are one."""
    profile = ink.sum(axis=1).astype(float)
    if not len(profile) or profile.max() <= 0:
        return []
    edges = np.diff(np.concatenate([[0], (profile > profile.max() * 0.04).astype(np.int8), [0]]))
    tops, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    tall = ends - tops >= dims.WELD_LEAST_HEIGHT
    tops, ends = np.maximum(tops[tall] - 4, 0), np.minimum(ends[tall] + 4, len(profile))
    if not len(tops):
        return []
    apart = np.concatenate([[True], tops[1:] - ends[:-1] >= 8])
    last = np.concatenate([apart[1:], [True]])
    return list(zip(tops[apart].tolist(), ends[last].tolist(), strict=True))


def weld_scores(band: np.ndarray) -> list[tuple[float, int, int]]:
    """score, cut, shift of a band's cuts whose upper part, moved sideways, continues in the lower one clearly better than as it lies.

    All shifts of a cut are compared at once, as windows over the upper edge between blank margins.
    """
    height, width = band.shape
    if height < dims.WELD_LEAST_HEIGHT or band.sum() < 3000:
        return []
    low, high = dims.WELD_SHIFTS
    shifts = np.arange(low, high, 2)
    shifts = np.concatenate([shifts, -shifts])
    shifts = shifts[np.abs(shifts) < width]
    out = []
    for cut in range(6, height - 5, 2):
        if min(band[:cut].sum(), band[cut:].sum()) < 1500:
            continue
        above, below = band[max(0, cut - 3) : cut].sum(axis=0).astype(float), band[cut : cut + 3].sum(axis=0).astype(float)
        still = np.minimum(above, below).sum() + 1e-6
        windows = np.lib.stride_tricks.sliding_window_view(np.pad(above, width), width)
        joined = np.minimum(windows[width + shifts], below).sum(axis=1)
        good = joined > still * dims.WELD_MARGIN
        out += list(zip(joined[good].tolist(), [cut] * int(good.sum()), shifts[good].tolist(), strict=True))
    return out


def weld_choice(scored: DataFrame, keys: tuple[str, ...], most: int = 3) -> DataFrame:
    """The best welds (score, cut, shift) of each band, one for each cell of five rows by sixteen columns."""
    cells = scored.withColumns({"cut_cell": F.floor(F.col("cut") / 5), "shift_cell": F.floor(F.col("shift") / 16)})
    return ranked(cells, keys, ("cut_cell", "shift_cell"), "score", [F.desc("cut"), F.desc("shift")], most).drop("cut_cell", "shift_cell")


def annotated(candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """candidates with label_match and label_conflicts against reviewed annotations; called after discovery is written, never within it.

    candidates: case_id, page_index, rotation, values (map of field to text). annotations: one row for a page, with rotation (null: any)
    and expected (map). Without an annotation, or at another turn, label_match is null and there are no conflicts.
    """
    reviewed = annotations.select("case_id", "page_index", F.col("rotation").alias("turn"), "expected")
    both = candidates.join(reviewed, ["case_id", "page_index"], "left")
    applies = F.col("expected").isNotNull() & (F.col("turn").isNull() | (F.col("turn") == F.col("rotation")))
    fields = F.map_keys("expected")
    got = F.filter(fields, lambda f: F.map_contains_key("values", f))
    conflicts = F.array_sort(F.filter(got, lambda f: ~F.element_at("values", f).eqNullSafe(F.element_at("expected", f))))
    match = F.when(applies, (F.size(fields) > 0) & (F.size(got) == F.size(fields)) & (F.size(conflicts) == 0))
    return both.withColumns({"label_match": match, "label_conflicts": F.when(applies, conflicts).otherwise(F.array().cast("array<string>"))}).drop("turn", "expected")


def lab_summary(runs: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row of counts: runs, those with candidates, candidates, runs by classification, candidates that match or contradict their labels.

    Both sides become one row each before they meet. runs: run, classification; candidates: run, label_match, label_conflicts.
    """
    kinds = ("pixel_supported", "underdetermined", "pixel_unsupported")
    a = runs.agg(F.count(F.lit(1)).alias("scan_page_rotations"), *(F.count_if(F.col("classification") == k).alias(k) for k in kinds))
    by_run = candidates.groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("label_match", F.lit(False))).alias("m"), F.count_if(F.size("label_conflicts") > 0).alias("c"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    b = by_run.agg(F.count(F.lit(1)).alias("triggered_rotations"), total("n", "candidate_count"), total("m", "label_matching_candidates"), total("c", "label_conflicting_candidates"))
    return a.withColumn("one", F.lit(1)).join(b.withColumn("one", F.lit(1)), "one").drop("one")
