"""Best-fit packing by a grouping genetic algorithm on islands with elite migration.

Documents become token pieces of at most CAPACITY tokens; whole ones are sequences by themselves. The others are dealt to
blocks of about BLOCK_ITEMS pieces by a hash. Each block is solved by ISLANDS islands, one row each: an island holds a
population of packings, starts from best-fit decreasing and shuffled best-fit ones, and breeds them. Crossover injects
whole well-filled bins of one parent into another, drops the bins that then hold a piece twice, and best-fits the displaced
pieces, after swapping them for one or two pieces of a bin where that fills it better; mutation empties the worst-filled bins. Between epochs each island's elite moves to the next island of its
block. An island stops early when no packing can have fewer bins, which on easy
lengths its first packing often shows; on hard ones (few pieces to a bin) the search decides.

Bins that the best island of a block leaves ill-filled are opened again, and their pieces go to the next, smaller set of
blocks, until one block holds the rest. So the loss does not grow with the number of blocks.

A piece is known by its row, so repeated rows and null ids are packed like others. Null and empty texts have one token, the
separator. Ties go to the lower row. An empty table gives no rows. Further columns are ignored. Token ids are made by
Rust code of the same vocabulary and pattern as the tokenizers library's; codec() compares the vocabulary's ranks with its
merges and takes the tokenizers library itself where they differ, and for texts that the faster code can't take.
"""

from __future__ import annotations

import json
import random
import sys
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.arrow import map_slices, small_batches
from evidentia.plans.workspace import Workspace

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = "byte_bpe_50k.json"
BLOCK_ITEMS = 4000
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 4
#: Generations without a bin less after which an island stops.
PATIENCE = 2
#: Bins of more pieces are not searched for swaps, as best fit fills them well and their pairs are many.
SWAPPED = 3
#: Bins with more free tokens than this are opened again for the next set of blocks.
FREE = 24


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def library(file: str) -> Callable[[str], np.ndarray]:
    """Text to ids by the tokenizers library."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(file)
    own.encode_special_tokens = True
    return lambda text: np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def codec(file: str) -> Callable[[str], np.ndarray]:
    """Text to ids. Texts whose runs of white space are too long for the faster code go to the tokenizers library."""
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"]
    letters, vocab = _byte_letters(), model["vocab"]
    pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
    ordered = [vocab.get(a + b) for a, b in pairs]
    same = model["type"] == "BPE" and spec["normalizer"] is None and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and not model["ignore_merges"]
    ranks = {bytes(letters[c] for c in word): i for word, i in vocab.items() if all(c in letters for c in word)}
    if not same or None in ordered or ordered != sorted(set(ordered)) or len(ordered) + 256 != len(vocab) or len(ranks) != len(vocab):
        return library(file)
    import tiktoken

    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        try:
            return np.array(fast.encode_ordinary(text), dtype="<u4")
        except BaseException as why:  # a panic of its pattern's stack derives from BaseException alone
            if type(why).__name__ != "PanicException":
                raise
            return library(file)(text)

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """start and length of each piece of n tokens; only the first can be shorter than capacity."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece."""

    def work(part: pa.RecordBatch) -> dict:
        encode = codec(file)
        out: list[tuple] = []
        end = np.array([SEPARATOR], "<u4")
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
            ids = np.concatenate([encode(text or ""), end])
            raw = memoryview(ids.tobytes())
            out += [(doc_id, k, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])) for k, (at, n) in enumerate(cut(len(ids), capacity))]
        cols = list(zip(*out, strict=True)) or [[]] * 5
        return {k: pa.array(v, t) for k, v, t in zip(("doc_id", "piece", "start", "length", "ids_crc32"), cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)}

    return map_slices(docs.select("doc_id", "text"), work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


Bin = list[int]


def best_fit(lengths: list[int], order: list[int], bins: list[Bin], capacity: int) -> list[Bin]:
    """bins, in place, with the items of order put where least room is left; ties go to the bin opened last."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i, own in enumerate(bins):
        free = capacity - sum(lengths[x] for x in own)
        if free:
            room[free].append(i)
            mask |= 1 << free
    for x in order:
        need = lengths[x]
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            i = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
            bins[i].append(x)
        else:
            free, i = capacity, len(bins)
            bins.append([x])
        free -= need
        if free:
            room[free].append(i)
            mask |= 1 << free
    return bins


def fullest(own: list[tuple[int, int]], low: int, high: int) -> tuple[int, ...] | None:
    """Places of one or two of the sorted lengths whose sum is the largest in (low, high]."""
    best, places = low, None
    j = bisect_right(own, (high, sys.maxsize)) - 1
    if j >= 0 and own[j][0] > best:
        best, places = own[j][0], (j,)
    i, j = 0, len(own) - 1
    while i < j and best < high:
        total = own[i][0] + own[j][0]
        if total > high:
            j -= 1
        else:
            if total > best:
                best, places = total, (i, j)
            i += 1
    return places


def least_bins(lengths: list[int], capacity: int) -> int:
    """A number of bins that no packing can go below: pieces over half a bin each need their own, and smaller ones what room these leave."""
    a = np.array(lengths, np.int64)
    big, small = a[2 * a > capacity], a[2 * a <= capacity]
    least = -(-int(a.sum()) // capacity)
    for t in [0, *np.unique(small).tolist()]:
        beside = big[big <= capacity - t]
        spare = len(beside) * capacity - int(beside.sum())
        least = max(least, len(big) + max(0, -(-(int(small[small >= t].sum()) - spare) // capacity)))
    return least


class Island:
    """A population of packings of one block; lengths fall from place to place."""

    def __init__(self, lengths: list[int], seed: int, capacity: int = CAPACITY):
        self.lengths, self.capacity, self.rng = lengths, capacity, random.Random(seed)
        self.least = -(-sum(lengths) // capacity)
        falling = list(range(len(lengths)))
        self.people = [best_fit(lengths, falling, [], capacity)]
        if not self.done():
            self.least = least_bins(lengths, capacity)

    def fitness(self, bins: list[Bin]) -> tuple[float, float]:
        """Fewer bins first, then the mean square of fills, which rewards full bins beside a nearly empty one."""
        fills = [sum(self.lengths[x] for x in b) for b in bins]
        return -len(bins), sum(f * f for f in fills) / max(1, len(fills))

    def done(self) -> bool:
        return min(map(len, self.people)) <= self.least

    def settle(self) -> None:
        """Fills the population with best-fit packings of partly shuffled orders."""
        n = len(self.lengths)
        while len(self.people) < POPULATION and not self.done():
            jitter = [i + self.rng.random() * n * 0.02 for i in range(n)]
            self.people.append(best_fit(self.lengths, sorted(range(n), key=jitter.__getitem__), [], self.capacity))

    def swap(self, bins: list[Bin], loose: list[int]) -> list[int]:
        """Puts loose items in bins for one or two of theirs, in place, where that fills the bin better; returns what is then loose."""
        own = sorted((self.lengths[x], x) for x in loose)
        for b in bins:
            free = self.capacity - sum(self.lengths[x] for x in b)
            if not free or len(b) > SWAPPED:
                continue
            for out in [(x,) for x in b] + list(combinations(b, 2)):
                need = sum(self.lengths[x] for x in out)
                if (into := fullest(own, need, need + free)):
                    b[:] = [x for x in b if x not in out] + [own[i][1] for i in into]
                    free -= sum(own[i][0] for i in into) - need
                    own = [v for i, v in enumerate(own) if i not in into]
                    for x in out:
                        insort(own, (self.lengths[x], x))
                    break
        return [x for _, x in own]

    def cross(self, giver: list[Bin], taker: list[Bin]) -> list[Bin]:
        by_fill = sorted(giver, key=lambda b: -sum(self.lengths[x] for x in b))
        injected = [list(b) for b in by_fill[: max(1, len(by_fill) // 2)] if self.rng.random() < 0.5]
        held = {x for b in injected for x in b}
        kept = [list(b) for b in taker if held.isdisjoint(b)]
        displaced = [x for b in taker if not held.isdisjoint(b) for x in b if x not in held]
        return best_fit(self.lengths, sorted(self.swap(kept, displaced)), injected + kept, self.capacity)

    def mutate(self, bins: list[Bin]) -> list[Bin]:
        ranked = sorted(bins, key=lambda b: -sum(self.lengths[x] for x in b))
        worst = max(1, len(ranked) // 50)
        kept, opened = ranked[:-worst], ranked[-worst:]
        also = {self.rng.randrange(len(kept)) for _ in range(min(worst, len(kept)))} if kept else set()
        freed = [x for b in [*opened, *(kept[i] for i in also)] for x in b]
        left = [list(b) for i, b in enumerate(kept) if i not in also]
        return best_fit(self.lengths, sorted(self.swap(left, freed)), left, self.capacity)

    def evolve(self, generations: int = GENERATIONS) -> list[Bin]:
        """The elite after some generations; the best POPULATION of parents and children live on."""
        self.settle()
        best, stale = max(map(self.fitness, self.people)), 0
        for _ in range(generations):
            if self.done() or stale == PATIENCE:
                break
            children = []
            for _ in range(POPULATION):
                giver, taker = self.rng.sample(self.people, 2)
                child = self.cross(giver, taker)
                children.append(self.mutate(child) if self.rng.random() < 0.3 else child)
            self.people = sorted(self.people + children, key=self.fitness, reverse=True)[:POPULATION]
            now = self.fitness(self.people[0])
            best, stale = now, 0 if now[0] > best[0] else stale + 1
        return max(self.people, key=self.fitness)


def _places(bins: list[Bin], n: int) -> list[int]:
    out = [0] * n
    for i, b in enumerate(bins):
        for x in b:
            out[x] = i
    return out


def _bins(places: list[int]) -> list[Bin]:
    out: list[Bin] = [[] for _ in range(max(places, default=-1) + 1)]
    for x, i in enumerate(places):
        out[i].append(x)
    return out


def solve(items: DataFrame, blocks: int, level: int, work: Workspace, capacity: int = CAPACITY) -> DataFrame:
    """item, length, sequence_id, offset, free (tokens left in its sequence) of items (item, length), dealt to blocks."""
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(blocks)).alias("block"))
    packed = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("n"), "item"))).alias("all"))
    held = work.table(f"blocks{level}", packed.select("block", F.transform("all", lambda x: x["item"]).alias("items"), F.transform("all", lambda x: -x["n"]).alias("lengths")))
    islands = held.select("block", "lengths").withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    islands = islands.repartition(max(1, min(blocks * ISLANDS, 1 << 15)), "block", "island").withColumn("guest", F.lit(None).cast("array<int>"))

    def evolve(epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, island, lengths, guest in zip(*(batch.column(k).to_pylist() for k in ("block", "island", "lengths", "guest")), strict=True):
                    own = Island(lengths, hash((level, block, island, epoch)), capacity)
                    if guest is not None:
                        own.people.insert(0, _bins(guest))
                    elite = own.evolve()
                    few, full = own.fitness(elite)
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int64()),
                        "island": pa.array([island], pa.int32()),
                        "elite": pa.array([_places(elite, len(lengths))], pa.list_(pa.int32())),
                        "few": pa.array([few], pa.float64()),
                        "full": pa.array([full], pa.float64()),
                    })

        return run

    schema = "block bigint, island int, elite array<int>, few double, full double"
    elites = work.table(f"elites{level}-0", islands.mapInArrow(evolve(0), schema))
    for epoch in range(1, EPOCHS):
        moved = elites.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("guest"))
        elites = work.table(f"elites{level}-{epoch}", islands.drop("guest").join(moved, ["block", "island"]).mapInArrow(evolve(epoch), schema))
    best = elites.groupBy("block").agg(F.max_by("elite", F.struct("few", "full", -F.col("island"))).alias("elite"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, items, lengths, elite in zip(*(batch.column(k).to_pylist() for k in ("block", "items", "lengths", "elite")), strict=True):
                used, offsets = [0] * (max(elite) + 1), []
                for i, n in zip(elite, lengths, strict=True):
                    offsets.append(used[i])
                    used[i] += n
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array(items, pa.int64()),
                    "length": pa.array(lengths, pa.int64()),
                    "sequence_id": pa.array([(level << 56) + (block << 16) + i for i in elite], pa.int64()),
                    "offset": pa.array(offsets, pa.int64()),
                    "free": pa.array([capacity - used[i] for i in elite], pa.int64()),
                })

    joined = held.join(best, "block").select("block", "items", "lengths", "elite")
    return work.table(f"placed{level}", joined.mapInArrow(place, "item bigint, length bigint, sequence_id bigint, offset bigint, free bigint"))


def pack(items: DataFrame, work: Workspace, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item, sequence_id, offset of every item (item, length up to capacity)."""
    small_batches(items.sparkSession)
    whole = items.filter(F.col("length") == capacity)
    done = whole.select("item", (F.lit(127 << 56) + F.col("item")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    todo, level = items.filter(F.col("length") < capacity).select("item", "length"), 0
    left = todo.count()
    while left:
        blocks = -(-left // block_items)
        placed = solve(todo, blocks, level, work, capacity)
        again = placed.filter(F.col("free") > FREE)
        remain = again.count() if blocks > 1 else 0
        if 2 * remain > left:  # most bins can't be filled; each block's packing stands, at most a bin or so above its own least
            remain = 0
        kept = placed if not remain else placed.filter(F.col("free") <= FREE)
        done = done.unionAll(kept.select("item", "sequence_id", "offset"))
        todo, left, level = again.select("item", "length"), remain, level + 1
    return done


def query(docs: DataFrame, file: str | None = None) -> DataFrame:
    """op9: every piece of every document and its place."""
    work = Workspace(docs.sparkSession, "packing")
    cut_up = work.table("pieces", pieces(docs, file or public_tokenizers.path(VOCABULARY)).withColumn("item", F.monotonically_increasing_id()))
    placed = pack(cut_up.select("item", "length"), work)
    return cut_up.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
