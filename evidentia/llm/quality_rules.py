"""Quality rules with host-level verdicts, in DataFrame functions only.

Each text gets its rule figures in one row-local pass (no exploding, no shuffle of text). Rule failures are added up by
host, for each rule; each host's failure rates are shrunk towards beta priors that are fitted to all hosts by moments. A
host whose rate of base failures lies over HOST_LIMIT by two posterior standard deviations loses its documents. A text that
fails one of the other rules alone may well be good (a table, a refrain), so its host decides: it stays if the host seldom
fails that rule, its rate and two deviations lying under TRUSTED, and goes otherwise. Verdicts are joined back to the
figures, which are small, by host; a hot host's rows are pre-aggregated, and its side of the join can be split.

Null texts have no words and fail. Documents of a null host share one host of their own. Repeated rows count each time. An
empty table gives no rows. Further columns are ignored. Texts of any length are rated whole; a text's windows must fit in
one task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.plans.workspace import Workspace

WORD_GAP = r"[\x20\x09-\x0D]+"
#: Words in a window, fewest words of a good text, and the highest share (%) of words in repeated windows.
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20
#: A host's shrunk failure rate above which its documents go, and the posterior deviations it must lie above it.
HOST_LIMIT = 0.5
DEVIATIONS = 2.0
#: A host is trusted with texts that fail a rule other than the base's if its rate of these lies surely under this.
TRUSTED = 0.02
#: Most symbols in 100 characters of words, and most words for each repeated line.
MOST_SYMBOLS = 10
WORDS_A_LINE = 20
#: The prior's weight in documents lies between these.
PRIOR_WEIGHT = (2.0, 1000.0)


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def repeat_words(tokens: Column) -> Column:
    """Words inside a window that stands twice or more in the text.

    Windows are hashed and sorted with their places; places of equal neighbours, sorted, cover WINDOW words each.
    """

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).cast("int").alias("last")),
            lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["last"])).cast("bigint").alias("n"), p.alias("last")),
            lambda s: s["n"],
        )

    def repeated(sorted_windows: Column) -> Column:
        same = lambda i, j: F.get(sorted_windows, i)["h"] == F.get(sorted_windows, j)["h"]
        kept = F.filter(sorted_windows, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        return covered(F.array_sort(F.transform(kept, lambda x: x["p"])))

    def of(hashed: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashed) - WINDOW),
            lambda i: F.struct(F.xxhash64(*(F.get(hashed, i + k) for k in range(WINDOW))).alias("h"), i.alias("p")),
        )
        return F.when(F.size(hashed) > WINDOW, let(F.sort_array(windows), repeated)).otherwise(F.lit(0).cast("bigint"))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), of)


def figures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns keep with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rated = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    out = docs.select(
        *keep,
        rated.alias("rated"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
    )
    out = out.select(*keep, "rated.n_words", "rated.word_chars", "n_symbols", "n_dup_lines", "rated.n_repeat_words")
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def rules() -> dict[str, Column]:
    """Whether a text fails each rule, by its figures."""
    return {
        "base": F.col("base_failed"),
        "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"),
        "lines": WORDS_A_LINE * F.col("n_dup_lines") > F.col("n_words"),
    }


def host_verdicts(rated: DataFrame) -> DataFrame:
    """For each host of rated (host, figures): host_docs, and for each rule its shrunk failure rate and that rate's posterior deviation."""
    failed = {r: F.sum(c.cast("bigint")).alias(f"{r}_failed") for r, c in rules().items()}
    hosts = rated.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"), *failed.values())
    rate = {r: F.col(f"{r}_failed") / F.col("host_docs") for r in failed}
    moments = [x for r, c in rate.items() for x in (F.avg(c).alias(f"{r}_m"), F.coalesce(F.var_samp(c), F.lit(0.0)).alias(f"{r}_v"))]
    prior = hosts.agg(*moments, F.avg(1 / F.col("host_docs")).alias("u"))
    low, high = PRIOR_WEIGHT
    weights = []
    for r in failed:
        m, v = F.col(f"{r}_m"), F.col(f"{r}_v")
        between = F.greatest(v - m * (1 - m) * F.col("u"), F.lit(1e-9))
        weights += [m, F.least(F.greatest(m * (1 - m) / between - 1, F.lit(low)), F.lit(high)).alias(f"{r}_k")]
    out = hosts.join(F.broadcast(prior.select(*weights)))  # one row
    for r in failed:
        m, k = F.col(f"{r}_m"), F.col(f"{r}_k")
        out = out.withColumn(f"{r}_rate", (F.col(f"{r}_failed") + m * k) / (F.col("host_docs") + k))
        out = out.withColumn(f"{r}_spread", F.sqrt(F.col(f"{r}_rate") * (1 - F.col(f"{r}_rate")) / (F.col("host_docs") + k + 1)))
    return out.select("host", "host_docs", *(f"{r}_{x}" for r in failed for x in ("rate", "spread")))


def query(docs: DataFrame) -> DataFrame:
    """op4: every document's figures and verdict, its host being source."""
    work = Workspace(docs.sparkSession, "quality")
    rated = work.table("figures", figures(docs, ["doc_id", "source"]).withColumnRenamed("source", "host"))
    joined = rated.join(host_verdicts(rated).withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host")))
    kept = ~F.col("base_failed") & (F.col("base_rate") - DEVIATIONS * F.col("base_spread") <= HOST_LIMIT)
    for r, fails in rules().items():
        if r != "base":
            kept = kept & (~fails | (F.col(f"{r}_rate") + DEVIATIONS * F.col(f"{r}_spread") <= TRUSTED))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.round("base_rate", 9).alias("host_rate"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text, source) AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, doc_id, host, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n >= 2),
cov AS (SELECT r, sum(least(5, coalesce(nx - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r),
f AS (SELECT doc_id, host, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN cov USING (r)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM f),
c AS (SELECT *, 100 * n_symbols > 10 * word_chars AS sym, 20 * n_dup_lines > n_words AS rep FROM b),
h AS (SELECT host, count(*) AS n, sum(base_failed::BIGINT) AS x, sum(sym::BIGINT) AS y, sum(rep::BIGINT) AS z FROM c GROUP BY host),
r AS (SELECT host, n, unnest(['x', 'y', 'z']) AS rule, unnest([x, y, z]) AS failed FROM h),
m AS (SELECT rule, avg(failed / n) AS m, coalesce(var_samp(failed / n), 0) AS v, avg(1.0 / n) AS u FROM r GROUP BY rule),
p AS (SELECT rule, m, least(greatest(m * (1 - m) / greatest(v - m * (1 - m) * u, 1e-9) - 1, 2.0), 1000.0) AS k FROM m),
s AS (SELECT host, rule, n + k AS total, (failed + m * k) / (n + k) AS rate FROM r JOIN p USING (rule)),
w AS (SELECT host, rule, rate, 2.0 * sqrt(rate * (1 - rate) / (total + 1)) AS off FROM s),
q AS (SELECT host, max(rate) FILTER (WHERE rule = 'x') AS base_rate, bool_or(rate - off <= 0.5) FILTER (WHERE rule = 'x') AS ok,
             bool_or(rate + off <= 0.02) FILTER (WHERE rule = 'y') AS sym_ok, bool_or(rate + off <= 0.02) FILTER (WHERE rule = 'z') AS rep_ok FROM w GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND ok AND (NOT sym OR sym_ok) AND (NOT rep OR rep_ok)) AS kept, round(base_rate, 9) AS host_rate
FROM c JOIN q ON c.host IS NOT DISTINCT FROM q.host
"""
