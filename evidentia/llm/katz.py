"""LM scoring: Katz backoff with Good-Turing discounts and exactly normalised backoff weights.

    P1(w)     = d_c c(w) / N for words of training texts; what is left belongs to one class of unknown words.
    Pn(w | h) = s(h) d_c c(h w) / c(h) if c(h w) > 0, else alpha(h) P(n-1)(w | h'), with h' the shorter context;
                P(n-1)(w | h') if h was never seen.
    alpha(h)  = (1 - sum of Pn over words seen after h) / (1 - sum of P(n-1) over them), so each context sums to 1.

d_r is Katz's Good-Turing discount for r <= CUTOFF from the counts of counts of each order, else 1; where these are
unusable (small corpora) it is 1 - D / r with D = n1 / (n1 + 2 n2). s(h) is 1 but for contexts whose discounts free less
than 1/2 in c(h) + 1/2 counts; it frees that much, so that no word has probability 0.

How it is laid out. Texts become chunks of about CHUNK_BYTES: each chunk's distinct words and token numbers are written once
to a shard in the shared folder. For each order, a chunk asks for its distinct n-grams, pre-counted, once: requests are
dealt by hash to parts that grow in number with the corpus, a part adds up the counts of all chunks and answers each
chunk, and the answers are a table partitioned by kind (answers, statistics, hot contexts), which is dropped once each
bundle's answers lie in a file of its own. The chunks of a bundle, whose number grows with the corpus, share one row for
each part. A part holds whole contexts, so it knows their sums; contexts
with over `hot` training tokens are spread over several parts by their next word, and their sums meet in one row each, at
most HOT_CONTEXTS of them by choice of `hot`. The last pass evaluates each token recursively from the answers. No table of
n-grams is ever sent to all executors.

What crosses the network is whole numbers only. The sum of P(n-1) over the words seen after h is s(h') / c(h') times the sum
of their discounted counts after h', as a word seen after h was seen after h'; so requests carry those counts, answers
their tallies, and the asking chunk, which knows s(h') / c(h'), gets the exact sum.

Null and empty texts are one end token. A null id is held out nowhere and trains nothing. Repeated rows count each time. An
empty table gives no rows; without training rows all tokens are unknown. Further columns are ignored. Texts of any length
are scored whole; one must fit in a worker's memory. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.arrow import remainder, small_batches, slices
from evidentia.llm.media_store import filesystem
from evidentia.llm.textscan import Words, mix, utf8
from evidentia.plans.workspace import Workspace

ORDER = 3
CUTOFF = 5
CHUNK_BYTES = 8 << 20
#: Distinct n-grams of all chunks in a part, about.
PART_GRAMS = 1_500_000
#: Bound on the rows of hot contexts' sums that are sent to all executors (100 bytes each).
HOT_CONTEXTS = 500_000
#: One more chunk in a bundle for each so many chunks, and the most chunks in one.
BUNDLE_STEP, BUNDLE = 512, 16
#: Tasks of a pass over bundles, at most.
MOST_TASKS = 32_768

_END = np.uint64(0x9E3779B97F4A7C15)
_ROW = "kind string, bundle string, part int, data binary"
_INDEX = "ordinal", "chunk", "length", "ids", "held", "kept"


# ---------------------------------------------------------------- packed arrays


def pack(a: np.ndarray, rising: bool = False) -> bytes:
    """An array of non-negative integers or doubles, bytes of equal weight side by side, compressed."""
    if a.dtype != np.float64:
        a = a.astype(np.uint64, copy=False)
        if rising and len(a):
            a = np.concatenate([a[:1], np.diff(a)])
        top = int(a.max()) if len(a) else 0
        size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        a, kind = a.astype(f"<u{size}"), size + (16 if rising else 0)
    else:
        kind = 32
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""
    return struct.pack("<BI", kind, len(a)) + zstandard.compress(planes, 1)


def unpack(raw: bytes) -> np.ndarray:
    kind, n = struct.unpack_from("<BI", raw)
    dtype = np.dtype("<f8") if kind == 32 else np.dtype(f"<u{kind & 15}")
    planes = np.frombuffer(zstandard.decompress(raw[5:]), np.uint8) if n else np.zeros(0, np.uint8)
    a = np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel() if n else np.zeros(0, dtype)
    if kind == 32:
        return a
    a = a.astype(np.uint64)
    return np.cumsum(a, dtype=np.uint64) if kind & 16 else a


def frame(*blobs: bytes) -> bytes:
    return struct.pack("<I", len(blobs)) + b"".join(struct.pack("<Q", len(b)) + b for b in blobs)


def unframe(raw: bytes) -> list[bytes]:
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        (size,) = struct.unpack_from("<Q", raw, at)
        out.append(raw[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def rows(kinds: list[str], bundles: list[str], parts: list[int], data: list[bytes]) -> pa.Table:
    return pa.table({"kind": pa.array(kinds, pa.string()), "bundle": pa.array(bundles, pa.string()), "part": pa.array(parts, pa.int32()), "data": pa.array(data, pa.binary())})


# ---------------------------------------------------------------- discounts and weights


def discounts(counts: np.ndarray) -> np.ndarray:
    """d_0..d_CUTOFF (d_0 unused) from counts[r] = number of n-grams seen r times, r up to CUTOFF + 1."""
    n = counts.astype(float)
    out = np.ones(CUTOFF + 1)
    if n[1] == 0:
        return out
    floor = 1 - n[1] / (n[1] + 2 * n[2]) / np.arange(1, CUTOFF + 1)
    tail = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
    for r in range(1, CUTOFF + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        out[r] = d if 0 < d < 1 else max(floor[r - 1], 0.05)
    return out


def unigram(count: np.ndarray, total: int, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """P1 of words with these training counts, 0 standing for the class of unknown words; and P1 of known words by discounted count."""
    d = discounts(counts)
    kept = float(total) - sum((1 - d[r]) * r * counts[r] for r in range(1, CUTOFF + 1))
    room = total + 0.5
    scale = min(1.0, total * total / (room * kept)) if kept else 1.0
    factor = scale / total if total else 0.0
    return np.where(count > 0, factor * d_of(d, count) * count, 1.0 - factor * kept), factor


def d_of(d: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.where(count <= CUTOFF, d[np.minimum(count, CUTOFF).astype(np.int64)], 1.0)


class Sums:
    """What is known of some contexts, as whole numbers, a row each.

    low[:, r - 1]: words seen r times after it; high: tokens of words seen oftener; below, above: the same of these words'
    counts after the next shorter context.
    """

    names = (*(f"low{r}" for r in range(1, CUTOFF + 1)), "high", *(f"below{r}" for r in range(1, CUTOFF + 1)), "above")

    def __init__(self, table: np.ndarray):
        self.table = table

    def of(self, at: np.ndarray) -> Sums:
        return Sums(self.table[at])

    def weights(self, d: np.ndarray, d_below: np.ndarray, factor_below: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """s(h) / c(h), and alpha(h); alpha is 1 for contexts never seen."""
        r = np.arange(1, CUTOFF + 1)
        t = self.table.astype(float)
        low, high = t[:, :CUTOFF], t[:, CUTOFF]
        total = low @ r + high
        kept = low @ (r * d[1:]) + high
        lower = factor_below * (t[:, CUTOFF + 1 : -1] @ (r * d_below[1:]) + t[:, -1])
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.minimum(1.0, total * total / ((total + 0.5) * kept))
            rest = 1.0 - lower
            scale = np.where(rest <= 1e-12, total / kept, scale)
            alpha = np.where(rest <= 1e-12, 0.0, (1.0 - scale * kept / total) / rest)
            return np.where(total > 0, scale / total, 0.0), np.where(total > 0, alpha, 1.0)

    def dump(self) -> list[bytes]:
        tallies = np.delete(self.table, (CUTOFF, 2 * CUTOFF + 1), axis=1)
        return [pack(tallies.T.ravel()), pack(self.table[:, CUTOFF]), pack(self.table[:, -1])]

    @staticmethod
    def load(blobs: list[bytes]) -> Sums:
        tallies, high, above = (unpack(b).astype(np.int64) for b in blobs)
        low = tallies.reshape(2 * CUTOFF, len(high)).T
        return Sums(np.concatenate([low[:, :CUTOFF], high[:, None], low[:, CUTOFF:], above[:, None]], axis=1))

    @staticmethod
    def add_up(run: np.ndarray, n: int, count: np.ndarray, below: np.ndarray) -> Sums:
        """Over n-grams that were seen: the context's number, the count, and the count after the shorter context."""
        out = np.empty((n, 2 * CUTOFF + 2), np.int64)
        for at, c in ((0, count), (CUTOFF + 1, below)):
            rare = c <= CUTOFF
            out[:, at : at + CUTOFF] = np.bincount(run[rare] * CUTOFF + c[rare] - 1, minlength=n * CUTOFF).reshape(n, CUTOFF)
            out[:, at + CUTOFF] = np.bincount(run[~rare], weights=c[~rare], minlength=n)
        return Sums(out)


# ---------------------------------------------------------------- chunks


class Chunk:
    """words: distinct word hashes, rising; tokens: their numbers, text after text; sizes: tokens of each text; train: whether each text teaches."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, train: np.ndarray):
        self.words, self.tokens, self.sizes, self.train = words, tokens, sizes, train
        ends = np.cumsum(sizes)
        self.heads = ends - sizes
        self.teaches = np.repeat(train, sizes)

    def dump(self) -> bytes:
        return frame(pack(self.words, rising=True), pack(self.tokens), pack(self.sizes), pack(self.train.astype(np.uint8)))

    @staticmethod
    def load(raw: bytes) -> Chunk:
        words, tokens, sizes, train = map(unpack, unframe(raw))
        return Chunk(words, tokens.astype(np.int64), sizes.astype(np.int64), train.astype(bool))


def tokenise(texts: list[pa.Array], train: np.ndarray) -> Chunk:
    """Texts of some batches as one chunk; every text ends with the end token."""
    hashes, sizes = [], []
    for text in texts:
        words = Words(*utf8(text))
        counts = np.diff(words.of)
        own = np.insert(words.hashes, words.of[1:], _END)
        hashes.append(own)
        sizes.append(counts + 1)
    every = np.concatenate(hashes)
    words, tokens = np.unique(every, return_inverse=True)
    return Chunk(words, tokens.astype(np.int64), np.concatenate(sizes).astype(np.int64), train)


def part_of(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


class Level:
    """What a chunk knows of one order: for each distinct n-gram (`of` maps tokens to them) count, number, s(h) / c(h) of its context, and p."""

    def __init__(self, of: np.ndarray, count: np.ndarray, number: np.ndarray | None, factor: np.ndarray, p: np.ndarray):
        self.of, self.count, self.number, self.factor, self.p = of, count, number, factor, p


class Model:
    """What all tasks know: bits of the number of parts, training tokens and texts; for each order counts of counts, offsets of parts' numbers, and hot contexts."""

    def __init__(self, bits: int, hot: int):
        self.bits, self.hot = bits, hot
        self.tokens = self.vocabulary = self.texts = 0
        self.counts: dict[int, np.ndarray] = {}
        self.offsets: dict[int, np.ndarray] = {}
        self.hot_sums: dict[int, tuple[np.ndarray, Sums]] = {}

    def numbers(self, order: int) -> int:
        return int(self.offsets[order][-1])


class Request:
    """A chunk's distinct n-grams of one order above 1, by part, context and word."""

    def __init__(self, chunk: Chunk, model: Model, order: int, below: Level, unigrams: Level):
        # every n-gram of the order below is a context; one more stands for the start of a text
        number = np.append(below.number, np.uint64(model.numbers(order - 1)))
        heat = np.append(below.count, model.texts)
        context = np.empty(len(chunk.tokens), np.int64)
        context[1:] = below.of[:-1]
        context[chunk.heads] = len(number) - 1
        # a hot context is as many contexts as there are parts for its words
        part = part_of(mix(number), model.bits)
        fan = np.minimum(heat // max(1, model.hot) + 1, 1 << model.bits)
        spread = np.flatnonzero(heat[context] > model.hot)
        if len(spread):
            word = mix(unigrams.number[unigrams.of[spread]])
            owner = context[spread]
            pair, at = distinct(owner, (word % fan[owner].astype(np.uint64)).astype(np.int64))
            owner, shift = owner[pair], (word[pair] % fan[owner[pair]].astype(np.uint64)).astype(np.int64)
            context[spread] = len(number) + at
            part = np.append(part, (part[owner] + shift) % (1 << model.bits))
            number, heat = np.append(number, number[owner]), np.append(heat, heat[owner])
        by_part, by_number = distinct(part, number)[1], ranks(np.argsort(unigrams.number))
        first, self.of = distinct(by_part[context], by_number[unigrams.of])
        self.count = np.bincount(self.of, weights=chunk.teaches, minlength=len(first)).astype(np.int64)
        under = below.of[first]
        self.sent, self.lower, self.factor = below.count[under], below.p[under], below.factor[under]
        context = context[first]
        self.part, self.context, self.is_hot = part[context], number[context], heat[context] > model.hot
        self.word = unigrams.number[unigrams.of[first]]
        new = np.ones(len(first), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        self.run_starts = np.flatnonzero(new)
        self.run_of = np.cumsum(new) - 1

    def slices(self) -> Iterator[tuple[int, slice, slice]]:
        """Each part with its rows and its runs of equal contexts."""
        cuts = np.flatnonzero(np.diff(self.part)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(self.part)], strict=True):
            yield int(self.part[a]), slice(a, b), slice(int(self.run_of[a]), int(self.run_of[b - 1]) + 1)

    def dump(self, own: slice, runs: slice) -> bytes:
        starts = self.run_starts[runs]
        lengths = np.diff(np.append(starts, own.stop))
        taught = self.count[own] > 0
        return frame(pack(self.context[starts], rising=True), pack(lengths), pack(self.is_hot[starts].astype(np.uint8)), pack(self.word[own]), pack(self.count[own]), pack(self.sent[own][taught]))


def ranks(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct pairs of non-negative integers, rising, and each pair's place among them."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits_b, bits_at = int(b.max()).bit_length(), (len(a) - 1).bit_length()
    bits = int(a.max()).bit_length() + bits_b
    if bits <= 63:
        key = (a.astype(np.int64) << bits_b) | b.astype(np.int64)
        if bits + bits_at <= 63:  # one sort of plain numbers that carry their places
            key = np.sort((key << bits_at) | np.arange(len(a)))
            order, key = key & ((1 << bits_at) - 1), key >> bits_at
        else:
            order = np.argsort(key)
            key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort((b, a))
        new = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    new = np.concatenate(([True], new))
    of = np.empty(len(a), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


# ---------------------------------------------------------------- parts


def tally(count: np.ndarray) -> np.ndarray:
    return np.bincount(count[(count > 0) & (count <= CUTOFF + 1)].astype(np.int64), minlength=CUTOFF + 2)


def opened(table: pa.Table) -> tuple[list[str], list[int], list[list[np.ndarray]]]:
    """Requests of a part: bundles, the number of chunks of each, and the chunks' arrays."""
    framed = [unframe(raw) for raw in table.column("data").to_pylist()]
    return table.column("bundle").to_pylist(), [len(f) for f in framed], [[unpack(b) for b in unframe(raw)] if raw else [] for f in framed for raw in f]


def closed(part: int, bundles: list[str], sizes: list[int], answers: list[bytes], stats: np.ndarray, hot: bytes = b"") -> pa.Table:
    """A part's answers, a row for each bundle, its statistics and its hot contexts."""
    ends = np.cumsum(sizes)
    data = [frame(*answers[b - n : b]) for n, b in zip(sizes, ends, strict=True)] + [frame(pack(stats))] + [hot] * bool(hot)
    kinds = ["answer"] * len(bundles) + ["stats"] + ["hot"] * bool(hot)
    return rows(kinds, [*bundles, *[""] * (len(data) - len(bundles))], [part] * len(data), data)


def answer_words(table: pa.Table) -> pa.Table:
    """A part of order 1: counts and numbers for each chunk, and the part's statistics."""
    bundles, sizes, asked = opened(table)
    some = [a for a in asked if a]
    every, of = np.unique(np.concatenate([a[0] for a in some]), return_inverse=True)
    count = np.bincount(of, weights=np.concatenate([a[1] for a in some]), minlength=len(every)).astype(np.int64)
    out, at = [], 0
    for a in asked:
        own = of[at : at + len(a[0])] if a else []
        out.append(frame(pack(count[own]), pack(own, rising=True)) if a else b"")
        at += len(own)
    return closed(table.column("part")[0].as_py(), bundles, sizes, out, np.array([count.sum(), (count > 0).sum(), len(every), *tally(count)], np.uint64))


def answer_grams(table: pa.Table, numbered: bool) -> pa.Table:
    """A part of a higher order: counts, sums of contexts and, if numbered, numbers for each chunk; statistics; hot contexts' sums."""
    bundles, sizes, asked = opened(table)
    some = [a for a in asked if a]
    contexts, run = np.unique(np.concatenate([a[0] for a in some]), return_inverse=True)
    every = np.repeat(run, np.concatenate([a[1] for a in some]).astype(np.int64))
    first, of = distinct(every, np.concatenate([a[3] for a in some]))
    counts = np.concatenate([a[4] for a in some])
    count = np.bincount(of, weights=counts, minlength=len(first)).astype(np.int64)
    below = np.zeros(len(first), np.int64)
    below[of[counts > 0]] = np.concatenate([a[5] for a in some])
    seen = count > 0
    sums = Sums.add_up(every[first][seen], len(contexts), count[seen], below[seen])
    out, at, at_run = [], 0, 0
    for a in asked:
        if not a:
            out.append(b"")
            continue
        own = of[at : at + len(a[3])]
        out.append(frame(pack(count[own]), pack(own, rising=True) if numbered else b"", *sums.of(run[at_run : at_run + len(a[0])]).dump()))
        at, at_run = at + len(a[3]), at_run + len(a[0])
    heat = np.concatenate([a[2] for a in some]) > 0
    hot = np.unique(run[heat])
    stats = np.array([count.sum(), seen.sum(), len(first), *tally(count)], np.uint64)
    return closed(table.column("part")[0].as_py(), bundles, sizes, out, stats, frame(pack(contexts[hot], rising=True), *sums.of(hot).dump()) if len(hot) else b"")


def grams_answerer(numbered: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda table: answer_grams(table, numbered)


# ---------------------------------------------------------------- passes


def write_chunks(docs: DataFrame, work: Workspace) -> DataFrame:
    """docs (doc_id, text, train, held_out) as chunks: an index of chunk, file, ordinal in the file, length, ids, held, n."""
    folder = f"{work.path}/tokens"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        file, out, at, held, size = f"{uuid.uuid4().hex}.tokens", None, 0, [], 0
        done: list[dict] = []

        def close() -> dict:
            nonlocal out, at, held, size
            if out is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{file}")
            chunk = tokenise([h.column("text") for h in held], np.concatenate([h.column("train").to_numpy(zero_copy_only=False) for h in held]))
            raw = chunk.dump()
            out.write(raw)
            row = {"chunk": f"{file}:{at}", "file": file, "ordinal": len(done), "length": len(raw), "ids": [x for h in held for x in h.column("doc_id").to_pylist()], "held": [x for h in held for x in h.column("held_out").to_pylist()], "n": len(chunk.tokens), "taught": int(chunk.train.sum())}
            at, held, size = at + len(raw), [], 0
            return row

        for batch in batches:
            for part in slices(batch):
                held.append(part)
                size += part.nbytes
                if size >= CHUNK_BYTES:
                    done.append(close())
        if held:
            done.append(close())
        if out is not None:
            out.close()  # nothing is given out before the file is whole
        for row in done:
            yield pa.RecordBatch.from_pydict({k: pa.array([row[k]], t) for k, t in (("chunk", pa.string()), ("file", pa.string()), ("ordinal", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("n", pa.int64()), ("taught", pa.int64()))})

    schema = "chunk string, file string, ordinal bigint, length bigint, ids array<bigint>, held array<boolean>, n bigint, taught bigint"
    return work.table("chunks", docs.select("doc_id", "text", "train", "held_out").mapInArrow(run, schema))


def read_chunk(folder: str, chunk: str, length: int) -> Chunk:
    system, path = filesystem(folder)
    file, at = chunk.rsplit(":", 1)
    with system.open_input_file(f"{path}/{file}") as f:
        return Chunk.load(f.read_at(length, int(at)))


def by_bundle(table: DataFrame, bundles: int) -> DataFrame:
    """Dealt out so that as many tasks work as there are bundles, however few bytes they read."""
    return table.repartition(max(1, min(MOST_TASKS, bundles)), "bundle")


def sent(bundle: str, asked: list[dict[int, bytes]]) -> pa.Table:
    """The requests of a bundle's chunks, one row for each part."""
    parts = sorted({part for own in asked for part in own})
    return rows(["ask"] * len(parts), [bundle] * len(parts), parts, [frame(*(own.get(part, b"") for own in asked)) for part in parts])


def ask_words(index: DataFrame, work: Workspace, bits: int, bundles: int) -> DataFrame:
    folder = f"{work.path}/tokens"

    def run(table: pa.Table) -> pa.Table:
        asked = []
        for name, length in zip(*members(table)[:2], strict=True):
            chunk = read_chunk(folder, name, length)
            count = np.bincount(chunk.tokens, weights=chunk.teaches, minlength=len(chunk.words)).astype(np.int64)
            cuts = np.searchsorted(part_of(chunk.words, bits), np.arange((1 << bits) + 1))
            asked.append({part: frame(pack(chunk.words[a:b], rising=True), pack(count[a:b])) for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a})
        return sent(table.column("bundle")[0].as_py(), asked)

    return by_bundle(index.select("bundle", "ordinal", "chunk", "length"), bundles).groupBy("bundle").applyInArrow(run, _ROW)


def members(table: pa.Table, *more: str) -> list[list]:
    """Names, lengths and further columns of a bundle's chunks, in the order of requests and answers."""
    return [c.to_pylist() for c in table.sort_by("ordinal").select(["chunk", "length", *more]).columns]


def resolve(chunk: Chunk, model: Model, answers: dict[int, dict[int, list[bytes]]], upto: int, asks: bool) -> tuple[list[Level], Request | None]:
    """Levels 1 to upto of a chunk from its answers by order and part; if it asks, the request for the order above."""
    counts, numbers = [], []
    for part in sorted(answers[1]):
        count, number = map(unpack, answers[1][part])
        counts.append(count.astype(np.int64))
        numbers.append(number + np.uint64(model.offsets[1][part]))
    count = np.concatenate(counts)
    p, scale = unigram(count, model.tokens, model.counts[1])
    levels = [Level(chunk.tokens, count, np.concatenate(numbers), np.full(len(count), scale), p)]
    for order in range(2, upto + 1):
        request = Request(chunk, model, order, levels[-1], levels[0])
        count, number, factor, alpha = [], [], [], []
        d, d_below = discounts(model.counts[order]), discounts(model.counts[order - 1])
        for part, own, runs in request.slices():
            blobs = answers[order][part]
            count.append(unpack(blobs[0]).astype(np.int64))
            if blobs[1]:
                number.append(unpack(blobs[1]) + np.uint64(model.offsets[order][part]))
            starts = request.run_starts[runs]
            sums, hot = Sums.load(blobs[2:]), request.is_hot[starts]
            if hot.any():
                known, whole = model.hot_sums[order]
                sums.table[hot] = whole.table[np.searchsorted(known, request.context[starts[hot]])]
            f, a = sums.weights(d, d_below, request.factor[starts])
            again = request.run_of[own] - runs.start
            factor.append(f[again])
            alpha.append(a[again])
        count, factor, alpha = map(np.concatenate, (count, factor, alpha))
        p = np.where(count > 0, factor * d_of(d, count) * count, alpha * request.lower)
        levels.append(Level(request.of, count, np.concatenate(number) if number else None, factor, p))
    return levels, Request(chunk, model, upto + 1, levels[-1], levels[0]) if asks else None


def with_answers(index: DataFrame, answered: DataFrame | None) -> DataFrame:
    """Rows of chunks (part null) and of answers."""
    own = index.select("bundle", F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("data"), *_INDEX)
    if answered is None:
        return own
    return own.unionByName(answered.filter("kind = 'answer'").select("bundle", "part", "data"), allowMissingColumns=True)


def split(table: pa.Table) -> tuple[pa.Table, dict[int, bytes]]:
    """Chunks' rows, and answers by part."""
    is_chunk = pc.is_null(table.column("part"))
    answers = table.filter(pc.invert(is_chunk))
    return table.filter(is_chunk), dict(zip(answers.column("part").to_pylist(), answers.column("data").to_pylist(), strict=True))


def keep(index: DataFrame, answered: DataFrame, work: Workspace, order: int, bundles: int) -> DataFrame:
    """The index, each bundle's answers now in a file beside those of lower orders, so that no later pass moves them again."""
    folder = f"{work.path}/kept"

    def run(table: pa.Table) -> pa.Table:
        chunks, answers = split(table)
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{path}/{name}") as out:
            out.write(frame(pack(np.array(list(answers), np.uint64)), *answers.values()))
        kept = pa.array([[*(k or []), name] for k in chunks.column("kept").to_pylist()], pa.list_(pa.string()))
        at = chunks.column_names.index("kept")
        return chunks.set_column(at, "kept", kept).select(["bundle", *_INDEX])

    kept = by_bundle(with_answers(index, answered), bundles).groupBy("bundle").applyInArrow(run, index.select("bundle", *_INDEX).schema)
    return work.table(f"index{order}", kept)


def kept_answers(work_path: str, names: list[str]) -> list[dict[int, bytes]]:
    """For each order the kept answers by part."""
    system, path = filesystem(f"{work_path}/kept")
    out = []
    for name in names:
        with system.open_input_stream(f"{path}/{name}") as f:
            parts, *data = unframe(f.read())
        out.append(dict(zip(unpack(parts).tolist(), data, strict=True)))
    return out


def gather(index: DataFrame, answered: DataFrame | None, work: Workspace, model: Model, upto: int, bundles: int, then: Callable[[str, list[list], Iterator], pa.Table], schema: str, asks: bool) -> DataFrame:
    """then(bundle, its chunks' ids and held, their levels and requests one after another) for each bundle with its answers.

    Answers of the lower orders are kept; answered has those of order upto, if they are not kept too.
    """
    work_path = work.path
    shared = index.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        chunks, last = split(table)
        names, lengths, ids, held = members(chunks, "ids", "held")
        known = kept_answers(work_path, chunks.column("kept")[0].as_py() or [])
        known = [{p: unframe(d) for p, d in k.items()} for k in [*known, *([last] if last else [])]]

        def each() -> Iterator[tuple[Chunk, list[Level], Request | None]]:
            for i, (name, length) in enumerate(zip(names, lengths, strict=True)):
                mine = {o: {p: unframe(framed[i]) for p, framed in k.items() if framed[i]} for o, k in enumerate(known, 1)}
                chunk = read_chunk(f"{work_path}/tokens", name, length)
                yield chunk, *resolve(chunk, shared.value, mine, upto, asks)

        return then(table.column("bundle")[0].as_py(), [ids, held], each())

    return by_bundle(with_answers(index, answered), bundles).groupBy("bundle").applyInArrow(run, schema)


def ask_grams(bundle: str, rest: list[list], each: Iterator) -> pa.Table:
    del rest
    return sent(bundle, [{part: request.dump(a, runs) for part, a, runs in request.slices()} for _, _, request in each])


def statistics(model: Model, order: int, answered: DataFrame) -> None:
    """Puts a level's counts of counts, offsets of numbers and hot contexts into model; a row for each part comes to the driver."""
    parts = 1 << model.bits
    sizes, counts = np.zeros(parts + 1, np.int64), np.zeros(CUTOFF + 2, np.int64)
    for r in answered.filter("kind = 'stats'").select("part", "data").toLocalIterator():
        total, seen, size, *low = unpack(unframe(bytes(r["data"]))[0]).astype(np.int64).tolist()
        sizes[r["part"] + 1] = size
        counts += low
        if order == 1:
            model.tokens += total
            model.vocabulary += seen
    model.counts[order], model.offsets[order] = counts, np.cumsum(sizes)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("data").to_pylist():
                context, *blobs = unframe(raw)
                sums = Sums.load(blobs).table
                yield pa.RecordBatch.from_pydict({"context": pa.array(unpack(context).astype(np.int64))} | {k: pa.array(sums[:, i]) for i, k in enumerate(Sums.names)})

    spelt = answered.filter("kind = 'hot'").select("data").mapInArrow(spell, "context bigint, " + ", ".join(f"{k} bigint" for k in Sums.names))
    summed = spelt.groupBy("context").agg(*(F.sum(k).alias(k) for k in Sums.names)).orderBy("context").toPandas()  # at most HOT_CONTEXTS
    model.hot_sums[order] = summed["context"].to_numpy().astype(np.uint64), Sums(summed[list(Sums.names)].to_numpy(np.int64).reshape(-1, len(Sums.names)))


def score(docs: DataFrame, order: int = ORDER, part_grams: int = PART_GRAMS, hot: int | None = None) -> DataFrame:
    """docs: doc_id, text, train, held_out. Returns the op1 columns. hot: training tokens above which a context is spread."""
    small_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "katz")
    index = write_chunks(docs, work)
    total, taught, chunks = index.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("taught"), F.lit(0)), F.count("*")).first()
    per = min(BUNDLE, 1 + chunks // BUNDLE_STEP)
    bundles = -(-chunks // per)
    index = index.withColumn("bundle", F.concat_ws(":", "file", F.floor(F.col("ordinal") / per))).withColumn("kept", F.lit(None).cast("array<string>"))
    model = Model(max(2, min(20, round(0.5 + log2(max(1, total / part_grams))))), hot or max(part_grams, total // HOT_CONTEXTS + 1))
    model.texts = taught
    parts = 1 << model.bits
    answered = None
    for n in range(1, order + 1 if total else 1):
        if n == 1:
            asked, answer = ask_words(index, work, model.bits, bundles), answer_words
        else:
            index = keep(index, answered, work, n - 1, bundles)
            work.drop(f"order{n - 1}")
            asked, answer = gather(index, None, work, model, n - 1, bundles, ask_grams, _ROW, asks=True), grams_answerer(n < order)
        answered = work.table(f"order{n}", asked.repartition(parts, "part").groupBy("part").applyInArrow(answer, _ROW), ["kind"])
        statistics(model, n, answered)

    tokens, vocabulary = model.tokens, model.vocabulary

    def evaluate(bundle: str, rest: list[list], each: Iterator) -> pa.Table:
        del bundle
        out = []
        for ids, held, (chunk, levels, _) in zip(*rest, each, strict=True):
            count = levels[0].count[levels[0].of]
            base = np.log10((count + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
            own = np.log10(levels[-1].p[levels[-1].of])
            heads = chunk.heads
            out.append(pa.table({
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": pa.array(chunk.sizes),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
                "train_tokens": pa.array(np.full(len(heads), tokens)),
                "base_score": pa.array(np.add.reduceat(base, heads)),
                "score": pa.array(np.add.reduceat(own, heads)),
            }))
        return pa.concat_tables(out)

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    if not total:
        return docs.sparkSession.createDataFrame([], schema)
    return gather(index, answered, work, model, order, bundles, evaluate, schema, asks=False)


def query(docs: DataFrame, **options) -> DataFrame:
    """op1: every document's scores; it learns from those whose remainder mod 10 is not 0."""
    held = remainder("doc_id", 10) == 0
    return score(docs.select("doc_id", "text", F.coalesce(~held, F.lit(False)).alias("train"), F.coalesce(held, F.lit(False)).alias("held_out")), **options)
