"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over the distinct terms of a whole text, x_i = 1. The
pairwise part is taken as half of |sum v_i|^2 - sum |v_i|^2. Terms are lower-cased runs of letters, digits and non-ASCII
characters, hashed to 64 bits and to one of BUCKETS buckets.

The machine is fitted on at most TRAIN_ROWS labelled documents, those with the smallest hashes of doc_id; its terms are the
at most TERMS buckets whose presence depends most on the label, in all texts or in those with a term of the first kind, as
a group's name may mean nothing but beside an insult. Both bound the broadcast model. Terms are counted and chosen by all
tasks, and the one that fits gets the sample's chosen terms only, so its memory does not grow with the texts' length. One
document in VALID is not fitted on: those choose the number of steps and the cut, which becomes a score of 0.5.

Null and empty texts get the score of a text without terms. Rows with a null or other label teach nothing; a document with
several label rows is toxic if any says so; one with several texts teaches by the greatest. Without labels the score is 0. A null id is neither held out nor used in
training. Repeated rows are scored alike. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.arrow import map_slices, remainder, slices, small_batches
from evidentia.llm.textscan import ALNUM, Words, utf8
from evidentia.plans.workspace import Workspace

#: Documented bound of the training sample, and on the terms the machine knows.
TRAIN_ROWS = 20_000
TERMS = 4096
BUCKETS = 1 << 24
#: Latent factors; numbers of steps over the sample, of which the best is taken; their size; pull towards 0.
FACTORS = 4
STEPS = (100, 150, 200, 300, 400)
STEP = 0.05
DECAY = 1e-4
#: A term must stand in this many training texts and depend on the label with this chi-square.
LEAST_TEXTS = 8
LEAST_CHI2 = 16.0
#: One row in so many chooses steps and cut.
VALID = 5
#: Terms of texts that the machine's sums take at once.
BLOCK = 1 << 22


def terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, sorted by text: (text's place, bucket)."""
    body, at = utf8(text)
    words = Words(body, at, ALNUM)
    counts = np.diff(words.of)
    place = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    both = np.unique((place << np.uint64(24)) | (words.hashes >> np.uint64(40)))
    return (both >> np.uint64(24)).astype(np.int64), (both & np.uint64(BUCKETS - 1)).astype(np.int64)


class Model:
    """terms: sorted buckets; w0, w, v: the machine's weights."""

    def __init__(self, buckets: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.terms, self.w0, self.w, self.v = buckets, w0, w, v

    def score(self, text: pa.Array) -> np.ndarray:
        of, bucket = terms(text)
        at, known = places(self.terms, bucket)
        return 1 / (1 + np.exp(-np.clip(forward(of[known], at[known], len(text), self.w0, self.w, self.v)[0], -30, 30)))


def forward(of: np.ndarray, at: np.ndarray, n: int, w0: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's sum for n texts with terms `at` in texts `of`, and each text's sum of factors."""
    linear, own, sums, squares = np.zeros(n), np.zeros(n), np.zeros((n, v.shape[1])), (v**2).sum(axis=1)
    for part in blocks(len(at)):
        texts, known = of[part], at[part]
        linear += np.bincount(texts, weights=w[known], minlength=n)
        own += np.bincount(texts, weights=squares[known], minlength=n)
        for f in range(v.shape[1]):
            sums[:, f] += np.bincount(texts, weights=v[known, f], minlength=n)
    return w0 + linear + 0.5 * ((sums**2).sum(axis=1) - own), sums


def blocks(size: int) -> list[slice]:
    return [slice(i, min(i + BLOCK, size)) for i in range(0, size, BLOCK)]


def chi_square(df: np.ndarray, tp: np.ndarray, n: float, positive: float) -> np.ndarray:
    """Each term's dependence on the label over n texts, positive of which are toxic: df have the term, tp of them toxic; 0 for rare terms."""
    df, tp = df.astype(float), tp.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = n * (tp * (n - positive - df + tp) - (df - tp) * (positive - tp)) ** 2 / (df * (n - df) * positive * (n - positive))
    return np.where((df >= LEAST_TEXTS) & np.isfinite(chi2), chi2, 0)


def choose(of: np.ndarray, bucket: np.ndarray, y: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The terms of the machine, sorted."""
    seen, place = np.unique(bucket, return_inverse=True)

    def over(rows: np.ndarray) -> np.ndarray:
        own = rows[of]
        df = np.bincount(place[own], minlength=len(seen))
        return chi_square(df, np.bincount(place[own], weights=y[of[own]], minlength=len(seen)), float(rows.sum()), float(y[rows].sum()))

    chi2 = over(inside)
    beside = np.zeros(len(y), bool)
    beside[of[(chi2 >= LEAST_CHI2)[place]]] = True
    chi2 = np.maximum(chi2, over(inside & beside))
    order = np.lexsort((seen, -chi2))[:TERMS]
    return enough(seen[order], chi2[order])


def enough(bucket: np.ndarray, chi2: np.ndarray) -> np.ndarray:
    """Of the first terms by dependence those that depend enough, sorted; the first one if none does."""
    chosen = chi2 >= LEAST_CHI2
    return np.sort(bucket[chosen] if chosen.any() else bucket[:1])


def set_aside(y: np.ndarray) -> np.ndarray:
    """The rows that choose steps and cut; none if either part would lack a kind of label."""
    n = len(y)
    aside = np.random.default_rng(5).permutation(n) % VALID == 0
    if not (0 < y[aside].sum() < aside.sum() and 0 < y[~aside].sum() < n - aside.sum()):
        aside[:] = False
    return aside


def constant(y: np.ndarray, factors: int = FACTORS) -> Model | None:
    """The model of labels of one kind or none."""
    n, positive = len(y), float(y.sum())
    if 0 < positive < n:
        return None
    base = float(np.clip(positive / n if n else 0, 1e-6, 1 - 1e-6))
    return Model(np.zeros(0, np.int64), float(np.log(base / (1 - base))), np.zeros(1), np.zeros((1, factors)))


def fit(of: np.ndarray, bucket: np.ndarray, y: np.ndarray, factors: int = FACTORS, pairs: bool = True) -> Model:
    """Chooses terms by chi-square and fits; of and bucket as of terms(). Without pairs factors stay 0."""
    if (same := constant(y, factors)) is not None:
        return same
    aside = set_aside(y)
    chosen = choose(of, bucket, y, ~aside)
    at, known = places(chosen, bucket)
    return fit_chosen(of[known], at[known], y, aside, chosen, factors, pairs)


def places(chosen: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket's place among the chosen ones, and whether it is one of them."""
    at = np.searchsorted(chosen, bucket)
    at[at == len(chosen)] = 0
    return at, chosen[at] == bucket if len(chosen) else np.zeros(len(at), bool)


def fit_chosen(of: np.ndarray, at: np.ndarray, y: np.ndarray, aside: np.ndarray, chosen: np.ndarray, factors: int = FACTORS, pairs: bool = True) -> Model:
    """Fits by full-batch Adam on the places `at` of chosen terms in texts `of`."""
    n = len(y)
    taught, judged = ~aside, aside if aside.any() else ~aside
    rng = np.random.default_rng(17)
    base = float(y[taught].mean())
    w0, w, v = float(np.log(base / (1 - base))), np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), factors)) * pairs
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), w, v)]
    best: tuple | None = None
    for step in range(1, STEPS[-1] + 2):
        total, sums = forward(of, at, n, w0, w, v)
        if step - 1 in STEPS:
            errors, cut = middle_cut(total[judged], y[judged])
            loss = float(np.logaddexp(0, np.where(y[judged] > 0, -1, 1) * (total[judged] - cut)).mean())
            if best is None or (errors, loss) < best[:2]:
                best = errors, loss, w0 - cut, w.copy(), v.copy()
        error = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - y) * taught / taught.sum()
        grads = [np.array([error.sum()]), np.zeros_like(w), np.zeros_like(v)]
        for part in blocks(len(at)):
            texts, known = of[part], at[part]
            own = error[texts]
            grads[1] += np.bincount(known, weights=own, minlength=len(w))
            for f in range(factors if pairs else 0):
                grads[2][:, f] += np.bincount(known, weights=own * (sums[texts, f] - v[known, f]), minlength=len(w))
        grads[1] += DECAY * w
        grads[2] += DECAY * v
        for k, g in enumerate(grads):
            m, s = state[k]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            move = STEP * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
            if k == 0:
                w0 -= float(move[0])
            elif k == 1:
                w -= move
            elif pairs:
                v -= move
    return Model(chosen, *best[2:])


def middle_cut(total: np.ndarray, y: np.ndarray) -> tuple[int, float]:
    """Fewest errors by which a sum can part these labels, and the middle of all such sums."""
    order = np.argsort(total, kind="stable")
    ranked = total[order]
    errors = np.concatenate([[0], np.cumsum(y[order])]) + np.concatenate([np.cumsum((1 - y[order])[::-1])[::-1], [0]])
    edges = np.concatenate([[ranked[0] - 1], (ranked[1:] + ranked[:-1]) / 2, [ranked[-1] + 1]])
    real = np.concatenate([[True], ranked[1:] > ranked[:-1], [True]])
    best = np.flatnonzero(real & (errors == errors[real].min()))
    return int(errors[best[0]]), float((edges[best[0]] + edges[best[-1]]) / 2)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """docs: doc_id and text of rows that may teach; labels: doc_id and toxic. Fitted in one task over at most rows texts."""
    small_batches(docs.sparkSession)
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    place = F.xxhash64("doc_id")
    total = marked.count()
    if total > 4 * rows:  # the smallest hashes lie below twice their expected bound, so few rows of each task are sorted
        marked = marked.filter(place < int(-(2.0**63) + 2.0**64 * 2 * rows / total))
    chosen = marked.orderBy(place, "doc_id").limit(rows)

    def to_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                of, bucket = terms(part.column("text"))
                ends = np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "toxic": part.column("toxic"), "terms": pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))})

    taught = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # chosen has at most `rows` rows
    taught = taught.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))  # and so has this, however often ids repeat
    rows_of = taught.select("doc_id", "text", "toxic").mapInArrow(to_terms, "doc_id bigint, toxic int, terms array<int>")

    work = Workspace(docs.sparkSession, "toxicity")
    held = work.table("terms", rows_of)
    sample = sorted((r["doc_id"], r["toxic"]) for r in held.select("doc_id", "toxic").collect())  # at most `rows`
    if not sample:
        return Model(np.zeros(0, np.int64), -30.0, np.zeros(1), np.zeros((1, FACTORS)))
    ids, y = np.array([i for i, _ in sample], np.int64), np.array([t for _, t in sample], float)
    if (same := constant(y)) is not None:
        return same
    aside = set_aside(y)
    terms_chosen = choose_in_tasks(held, ids[~aside], y[~aside], work)

    def known_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, bucket = flattened(batch)
            at, known = places(terms_chosen, bucket)
            ends = np.searchsorted(of[known], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "at": pa.ListArray.from_arrays(pa.array(ends), pa.array(at[known].astype(np.int16)))})

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        at = table.column("at").combine_chunks().take(pa.array(np.argsort(table.column("doc_id").to_numpy())))
        of = np.repeat(np.arange(len(at), dtype=np.int32), np.asarray(pc.list_value_length(at)))
        model = fit_chosen(of, np.asarray(at.flatten()), y, aside, terms_chosen)
        yield pa.RecordBatch.from_pydict({"w0": pa.array([model.w0]), "w": pa.array([model.w], pa.list_(pa.float64())), "v": pa.array([model.v.ravel()], pa.list_(pa.float64()))})

    known = held.mapInArrow(known_terms, "doc_id bigint, at array<smallint>")
    (one,) = known.repartition(1).mapInArrow(learn, "w0 double, w array<double>, v array<double>").collect()
    return Model(terms_chosen, one["w0"], np.array(one["w"]), np.array(one["v"]).reshape(-1, FACTORS))


def flattened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Terms as of terms(), of a batch of lists of them."""
    lists = batch.column("terms")
    return np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(lists))), np.asarray(lists.flatten()).astype(np.int64)


def choose_in_tasks(held: DataFrame, ids: np.ndarray, y: np.ndarray, work: Workspace) -> np.ndarray:
    """What choose() gives for the rows of held (doc_id, toxic, terms), inside being those of the ids, whose labels are y."""
    schema = "bucket int, df bigint, tp bigint"

    def counts(strong: np.ndarray | None) -> DataFrame:
        """Texts with each bucket and toxic ones, over ids with a strong bucket, if given; bucket -1 stands in all of these."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            df, tp, seen = np.zeros(BUCKETS + 1, np.int32), np.zeros(BUCKETS + 1, np.int32), np.zeros(BUCKETS + 1, bool)
            for batch in batches:
                of, bucket = flattened(batch)
                inside = np.isin(batch.column("doc_id").to_numpy(), ids)
                if strong is None:
                    seen[bucket] = True
                else:
                    beside = np.zeros(batch.num_rows, bool)
                    beside[of[(strong[bucket >> 6] >> (bucket & 63).astype(np.uint64)) & np.uint64(1) > 0]] = True
                    inside &= beside
                toxic = batch.column("toxic").to_numpy() > 0
                np.add.at(df, bucket[inside[of]], 1)
                np.add.at(tp, bucket[(inside & toxic)[of]], 1)
                df[BUCKETS] += inside.sum()
                tp[BUCKETS] += (inside & toxic).sum()
            at = np.flatnonzero(seen | (df > 0))
            for part in (at[i : i + (1 << 16)] for i in range(0, len(at), 1 << 16)):
                named = np.where(part == BUCKETS, -1, part).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(named), "df": pa.array(df[part].astype(np.int64)), "tp": pa.array(tp[part].astype(np.int64))})

        return held.select("doc_id", "toxic", "terms").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("df").alias("df"), F.sum("tp").alias("tp"))

    def dependence(counted: DataFrame, n: float, positive: float) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chi2 = chi_square(batch.column("df").to_numpy(), batch.column("tp").to_numpy(), n, positive)
                yield pa.RecordBatch.from_pydict({"bucket": batch.column("bucket"), "chi2": pa.array(chi2)})

        return counted.filter("bucket >= 0").select("bucket", "df", "tp").mapInArrow(run, "bucket int, chi2 double")

    alone = work.table("alone", dependence(counts(None), float(len(y)), float(y.sum())))
    strong = np.zeros(BUCKETS >> 6, np.uint64)
    bit: Column = F.expr("shiftleft(1L, bucket % 64)")
    for r in alone.filter(F.col("chi2") >= LEAST_CHI2).groupBy(F.shiftright("bucket", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        strong[r["word"]] = np.int64(r["bits"]).view(np.uint64)
    found = alone
    if strong.any():
        beside = work.table("beside", counts(strong))
        whole = beside.filter("bucket = -1").first()
        found = alone.unionAll(dependence(beside, float(whole["df"]), float(whole["tp"])))
    first = found.groupBy("bucket").agg(F.max("chi2").alias("chi2")).orderBy(F.desc("chi2"), "bucket").limit(TERMS).collect()
    return enough(np.array([r["bucket"] for r in first], np.int64), np.array([r["chi2"] for r in first], float))


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns keep of docs with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double, predicted int"

    def work(part: pa.RecordBatch) -> dict:
        score = shared.value.score(part.column("text"))
        return {k: part.column(k) for k in keep} | {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    return map_slices(docs.select(*dict.fromkeys([*keep, "text"])), work, fields)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op6: every document's toxicity, learnt from labels of those whose remainder mod 5 is not 0."""
    model = train(docs.filter(remainder("doc_id", 5) != 0), labels.filter(remainder("doc_id", 5) != 0))
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", held, "text"), model, ["doc_id", "held_out"])
