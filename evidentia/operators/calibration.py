"""How decisions compare with truth: tables by path, shrunk accuracies, Brier scores, confusion and fields' accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.functions.text import normal_label


def path_table(decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """path, n, correct, and errors by true label, of decisions (case_id, path, adjudication) with a truth (case_id, truth)."""
    joined = decisions.join(truth.select("case_id", "truth"), "case_id")
    wrong = lambda c: F.count_if((F.col("truth") == c) & (F.col("adjudication") != c)).alias(f"err_{c.lower()}")
    return joined.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("adjudication") == F.col("truth")).alias("correct"), *map(wrong, dims.LABELS))


def shrunk(table: DataFrame) -> DataFrame:
    """table with accuracy, drawn towards the overall accuracy with the weight of ten cases, and the errors' shares."""
    overall = table.agg((F.sum("correct") / F.greatest(F.sum("n"), F.lit(1))).alias("overall"))
    out = table.join(F.broadcast(overall))  # one row
    m = dims.SHRINKAGE
    wrong = F.greatest(F.col("n") - F.col("correct"), F.lit(1))
    return out.select(*table.columns, ((F.col("correct") + m * F.col("overall")) / (F.col("n") + m)).alias("accuracy"), *((F.col(f"err_{c.lower()}") / wrong).alias(f"share_{c.lower()}") for c in dims.LABELS))


def holdout_check(decisions: DataFrame, truth: DataFrame, held: Column) -> DataFrame:
    """n, accuracy, brier, points: estimates from the other cases, tried on the held ones."""
    fit = shrunk(path_table(decisions.filter(~held), truth))
    overall = fit.agg((F.sum("correct") / F.greatest(F.sum("n"), F.lit(1))).alias("overall"))
    tried = decisions.filter(held).join(truth.select("case_id", "truth"), "case_id").join(F.broadcast(fit.select("path", F.col("accuracy").alias("q"))), "path", "left").join(F.broadcast(overall))
    right = (F.col("adjudication") == F.col("truth")).cast("double")
    q = F.coalesce("q", "overall")
    out = tried.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"), F.avg((q - right) * (q - right)).alias("brier"))
    return out.withColumn("points", 20 * F.greatest(F.lit(0.0), 1 - 2 * F.col("brier")))


def confusion(decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """truth, adjudication, n, and whether this is the error that must not happen: an approval of what is to be denied."""
    joined = decisions.join(truth.select("case_id", "truth"), "case_id").groupBy("truth", "adjudication").agg(F.count(F.lit(1)).alias("n"))
    return joined.withColumn("catastrophic", (F.col("truth") == "DENIED") & (F.col("adjudication") == "APPROVED"))


def normal_flags(value: Column) -> Column:
    """Flags in one order; unread and unknown ones count as none."""
    parts = F.array_sort(F.filter(F.transform(F.split(normal_label(value), r"\|"), F.trim), lambda p: p != ""))
    joined = F.array_join(parts, "|")
    return F.when(joined.isin("", "none", "null", "unknown"), "none").otherwise(joined)


def field_accuracy(rows: DataFrame, gold: DataFrame) -> DataFrame:
    """fld, hits, n, accuracy, points: each field's share of right values, and its part of the 50 points."""
    fields = tuple(dims.FIELD_WEIGHTS)
    truth = gold.select("case_id", *(F.col(f).alias(f"gold_{f}") for f in fields))
    norm = lambda f, c: normal_flags(F.col(c)) if f == "risk_flags" else normal_label(F.col(c))
    both = rows.join(truth, "case_id").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(norm(f, f) == norm(f, f"gold_{f}")).alias(f) for f in fields))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("fld"), F.col(f).alias("hits"), F.lit(w).alias("weight")) for f, w in dims.FIELD_WEIGHTS.items())))
    out = both.select("n", each.alias("e"))
    accuracy = F.col("e.hits") / F.col("n")
    return out.select("e.fld", "e.hits", "n", accuracy.alias("accuracy"), (50 * F.col("e.weight") * accuracy / sum(dims.FIELD_WEIGHTS.values())).alias("points"))
