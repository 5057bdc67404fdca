"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of every labelled training text, each task adding up one count row for each language before the
shuffle. The log-probability matrix has one row for each language and `buckets` columns; the product is bounded by
MODEL_CELLS, and a table with more languages gets fewer buckets. Scores are sums over the n-grams of whole texts.

Nulls, empty texts and texts without a letter are `und` with score 0. Rows whose language or id is null teach nothing;
a null id is neither held out nor used in training. Without a training row every text is `und`. Ties go to the first
language in sorted order. Repeated rows count each time. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.arrow import map_slices, remainder, small_batches, slices
from evidentia.llm.textscan import mix

#: Orders of n-grams over code points of the lower-cased text.
ORDERS = (2, 3)
#: Largest number of hash buckets, and of cells of the broadcast matrix (float32: 64 MB).
BUCKETS = 1 << 16
MODEL_CELLS = 1 << 24
#: Added to every count.
SMOOTHING = 0.5


def buckets_for(languages: int) -> int:
    """A power of two, so that all languages' rows fit in MODEL_CELLS."""
    n = BUCKETS
    while n > 256 and n * max(1, languages) > MODEL_CELLS:
        n //= 2
    if n * languages > MODEL_CELLS:
        raise ValueError(f"{languages} languages exceed the model's bound")
    return n


def grams(text: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and for each its text's place. Runs of characters that are no letters count as one space."""
    lowered = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), "")), r"\P{L}+", " ")
    joined = "\n".join(lowered.to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    breaks = points == 10
    of = np.cumsum(breaks, dtype=np.int32)
    out, places = [], []
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        value = np.full(n, order, dtype=np.uint64)
        for i in range(order):
            value = (value * np.uint64(0x100000001B3)) ^ points[i : i + n]
        whole = of[:n] == of[order - 1 :]
        whole &= ~breaks[:n]
        out.append((mix(value[whole]) & np.uint64(buckets - 1)).astype(np.int32))
        places.append(of[:n][whole])
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(out), np.concatenate(places)


def train(docs: DataFrame, buckets: int | None = None) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and the matrix of log-probabilities with the log prior in its last column.

    docs: text and lang of the training rows.
    """
    small_batches(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull()).select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MODEL_CELLS // 256 + 1).toLocalIterator()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, 1), np.float32)
    width = buckets or buckets_for(len(languages))
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                hashed, of = grams(part.column("text"), width)
                who = np.array([place[x] for x in part.column("lang").to_pylist()], dtype=np.int64)
                for one in np.unique(who[of]) if len(of) else ():
                    held[one] = held.get(one, 0) + np.bincount(hashed[who[of] == one], minlength=width)
        for one, row in held.items():
            at = np.flatnonzero(row)
            for block in range(0, width, 4096):
                own = at[(at >= block) & (at < block + 4096)]
                if len(own):
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([one], pa.int32()), "block": pa.array([block], pa.int32()), "at": pa.array([own.astype(np.int32)], pa.list_(pa.int32())), "n": pa.array([row[own]], pa.list_(pa.int64()))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for lang, block, at, n in zip(*(batch.column(k).to_pylist() for k in ("lang", "block", "at", "n")), strict=True):
                held.setdefault((lang, block), np.zeros(4096, np.int64))[np.array(at) - block] += n
        for (lang, block), row in held.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.int32()), "block": pa.array([block], pa.int32()), "n": pa.array([row], pa.list_(pa.int64()))})

    counted = labelled.mapInArrow(count, "lang int, block int, at array<int>, n array<bigint>")
    summed = counted.repartition("lang", "block").mapInArrow(add, "lang int, block int, n array<bigint>")
    counts = np.zeros((len(languages), width))
    for r in summed.toLocalIterator():
        counts[r["lang"], r["block"] : r["block"] + 4096] = r["n"][: width - r["block"]]
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * width)
    prior = np.log(np.array([sizes[x] for x in languages], dtype=float) / sum(sizes.values()))
    return languages, np.concatenate([logs, prior[:, None]], axis=1).astype(np.float32)


def scores(text: pa.Array, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the best row of matrix, and its posterior probability."""
    width = matrix.shape[1] - 1
    hashed, of = grams(text, width)
    total = np.tile(matrix[:, -1].astype(np.float64)[:, None], (1, len(text)))
    for row, out in zip(matrix, total, strict=True):
        out += np.bincount(of, weights=row[hashed], minlength=len(text))
    best = total.argmax(axis=0)
    with np.errstate(under="ignore"):
        return best, 1 / np.exp(total - total.max(axis=0)).sum(axis=0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str]) -> DataFrame:
    """Columns keep of docs with lang_pred and score; only the text is read to predict."""
    languages, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast(matrix)
    schema = docs.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", lang_pred string, score double"

    def work(part: pa.RecordBatch) -> dict:
        text = part.column("text")
        lettered = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if languages:
            best, sure = scores(text, shared.value)
        else:
            best, sure, lettered = np.zeros(len(text), int), np.zeros(len(text)), np.zeros(len(text), bool)
        said = [languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
        return {k: part.column(k) for k in keep} | {"lang_pred": pa.array(said, pa.string()), "score": pa.array(np.where(lettered, sure, 0.0))}

    return map_slices(docs.select(*dict.fromkeys([*keep, "text"])), work, fields)


def query(docs: DataFrame) -> DataFrame:
    """op3: every document's language, learnt from those whose remainder mod 3 is not 1."""
    model = train(docs.filter(remainder("doc_id", 3) != 1))
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", held, "text"), model, ["doc_id", "held_out"])
