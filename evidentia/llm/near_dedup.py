"""MinHash near-dedup by an LSH forest.

Each text is the set of its distinct SHINGLE-word shingles, and texts with 100 * intersection >= 100 * similarity * union are
linked. Texts with the same set are one node from the start, so copies make no pairs. A node's signature of TREES * DEPTH
minima gives TREES sorted orders; a region is a run of nodes that share at least SHALLOW minima of an order. Candidates are:

* all pairs of a region of at most REGION nodes;
* in a larger region, all pairs of those of its parts that one more minimum, or two or three, cut down to REGION nodes, so
  that depth adapts to each region; and each node's WINDOW neighbours before it, whose common prefixes are longest;
* in a larger region whose nodes still fall into several components, each node with the region's best linked nodes; and, in
  what is still split after that, all pairs of different components that share one of their rarest shingles. Two sets that are
  similar enough share one among a fixed part of their rarest, so within larger regions no link between components is lost but by the sketches below.

The orders are dealt out by ranges of the sorted order itself, so no region, however hot, lies in one task; runs at the ends
of ranges are joined in a second, small pass. Candidates whose signatures make a similarity of 0.8 all but impossible are
dropped, the others confirmed on full sets: first each node's best one, then what still lies between components.
The chance that two nodes at similarity 0.8 share no region is 1e-5, and less for more similar ones.

Texts without words have no set and are linked with nothing. Rows with a null id are linked with nothing, have a null
component and are kept. Rows of one id are one document; each has its own n_shingles. An empty table gives no rows; further
columns are ignored. A text of any length is taken whole; its set must fit in a worker's memory. Shingles are told apart by
55-bit hashes when sets are made and by 48 bits of them when they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.arrow import map_slices, small_batches
from evidentia.llm.components import components
from evidentia.llm.katz import pack, unpack
from evidentia.llm.textscan import Words, keys, mix, utf8
from evidentia.plans.workspace import Workspace

TREES, DEPTH, SHALLOW = 16, 6, 3
REGION, WINDOW, HUBS = 32, 4, 3
#: Two-bit sketches of a set, and the share of similar pairs whose sketches may agree too seldom.
SKETCHES, MISSED = 96, 1e-5
#: Rows of a sorted order in a task, about.
ROWS = 300_000
#: Rows of a batch of what a task found. A row may be in REGION - 1 pairs, so a task's millions never lie in one batch.
FOUND_ROWS = 1 << 14
#: Bits of the filter that tells which texts are read again; its size does not depend on the data.
FILTER_BITS = 25
#: Bits of the table of shingle counts that puts the rarest first; its size does not depend on the data.
COUNT_BITS = 21
#: Nodes of a shingle that meet in a task, about; those of more common ones meet block by block.
BLOCK = 2048

_A, _B = (keys(TREES * DEPTH, s).astype(np.uint32) | np.uint32(1) for s in (11, 12))


@cache
def least_agreeing(similarity: float) -> int:
    """How many sketches agree for all but MISSED of the pairs at this similarity; unequal minima agree one time in four."""
    p, below = similarity + (1 - similarity) / 4, 0.0
    for k in range(SKETCHES + 1):
        below += comb(SKETCHES, k) * p**k * (1 - p) ** (SKETCHES - k)
        if below > MISSED:
            return k
    return SKETCHES


def shingle_sets(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sorted distinct shingles, of 55 bits, and where each text's begin; the last offset is the end. At most 512 texts."""
    words = Words(*utf8(text))
    hashes, of = words.hashes, words.of
    counts = np.diff(of)
    n = len(hashes)
    own = np.repeat(np.arange(len(counts)), counts)
    salt = keys(size + 1, 7)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value[: n - k] += hashes[k:] * salt[k]
    whole = np.arange(n) + size <= np.repeat(of[1:], counts)
    few = np.flatnonzero((counts > 0) & (counts < size))
    shorts = np.array([(hashes[of[i] : of[i + 1]] * salt[: counts[i]]).sum() for i in few], np.uint64) + salt[size] * counts[few].astype(np.uint64)
    value = np.concatenate([mix(value[whole]), mix(shorts)]) >> np.uint64(9)
    both = np.unique((np.concatenate([own[whole], few]).astype(np.uint64) << np.uint64(55)) | value)
    at = np.append(np.searchsorted(both, np.arange(len(counts), dtype=np.uint64) << np.uint64(55)), len(both))
    return both & np.uint64((1 << 55) - 1), at


def minima(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, TREES * DEPTH) smallest hashes; at must not have empty ranges."""
    out = np.empty((len(at) - 1, len(_A)), np.uint32)
    short = (values >> np.uint64(20)).astype(np.uint32)
    for j in range(len(_A)):
        out[:, j] = np.minimum.reduceat(short * _A[j] + _B[j], at[:-1])
    return out


def sketch(low: np.ndarray) -> np.ndarray:
    """(texts, 3) of two bits for each minimum."""
    bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64)
    return np.stack([(bits[:, k * 32 : (k + 1) * 32] << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64) for k in range(3)], axis=1)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the 96 sketches of rows a and b agree."""
    x = a ^ b
    return 96 - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1).astype(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, f1 and f2 (the set's fingerprint) and low (the minima) of each document; low is null without a set."""

    def work(part: pa.RecordBatch) -> dict:
        values, at = shingle_sets(part.column("text"), size)
        n = np.diff(at)
        some = np.flatnonzero(n)
        f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
        low: list[bytes | None] = [None] * len(n)
        if len(some):
            heads = at[:-1][some]
            f1[some] = np.add.reduceat(mix(values), heads)
            f2[some] = np.add.reduceat(mix(values ^ np.uint64(0x5DEECE66D)), heads)
            for i, row in zip(some, minima(values, np.append(heads, at[-1])), strict=True):
                low[i] = row.tobytes()
        return {"doc_id": part.column("doc_id"), "n_shingles": pa.array(n.astype(np.int64)), "f1": pa.array(f1.view(np.int64)), "f2": pa.array(f2.view(np.int64)), "low": pa.array(low, pa.binary())}

    return map_slices(docs.select("doc_id", "text"), work, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, low binary")


_ORDER = "tree int, k0 bigint, k1 bigint, k2 bigint, id bigint, n bigint, s0 bigint, s1 bigint, s2 bigint"
_NAMES = [x.split()[0] for x in _ORDER.split(", ")]
_FOUND = f"kind string, a bigint, b bigint, agree int, {_ORDER}"


def sorted_orders(nodes: DataFrame) -> DataFrame:
    """A row for each node (id, n, low) and tree: its DEPTH minima as three longs, and the sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = np.frombuffer(b"".join(batch.column("low").to_pylist()), np.uint32).reshape(-1, TREES * DEPTH)
            s = sketch(low).view(np.int64)
            wide = low.reshape(-1, TREES, DEPTH // 2, 2).astype(np.uint64)
            key = ((wide[..., 0] << np.uint64(32)) | wide[..., 1]).view(np.int64)
            for tree in range(TREES):
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(low), tree, np.int32)),
                    **{f"k{i}": pa.array(key[:, tree, i]) for i in range(3)},
                    "id": batch.column("id"),
                    "n": batch.column("n"),
                    **{f"s{i}": pa.array(s[:, i]) for i in range(3)},
                })

    return nodes.select("id", "n", "low").mapInArrow(run, _ORDER)


def _changes(cols: dict[str, np.ndarray]) -> list[np.ndarray]:
    """For each depth from SHALLOW to DEPTH, where a row's prefix of that depth differs from the row before."""
    keys_of = [cols["k0"], cols["k1"] >> 32, cols["k1"], cols["k2"] >> 32, cols["k2"]]  # depths 2, 3, 4, 5, 6
    new = np.ones(len(cols["id"]), dtype=bool)
    new[1:] = cols["tree"][1:] != cols["tree"][:-1]
    out = []
    for depth, key in enumerate(keys_of, 2):
        new = new.copy()
        new[1:] |= key[1:] != key[:-1]
        if depth >= SHALLOW:
            out.append(new)
    return out


def regions_of(changes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each row's region and the regions' sizes."""
    region = np.cumsum(changes[0]) - 1
    return region, np.bincount(region, minlength=region[-1] + 1 if len(region) else 0)


def pairs_of(cols: dict[str, np.ndarray], similarity: float) -> Iterator[dict[str, np.ndarray]]:
    """Candidates (a < b, agree) of rows in sorted order, at most one for each row at a time."""
    n = len(cols["id"])
    changes = _changes(cols)
    region, sizes = regions_of(changes)
    unit, small = region.copy(), sizes[region] <= REGION
    top = int(region[-1]) + 1 if n else 0
    for new in changes[1:]:
        deeper = np.cumsum(new) - 1
        fits = ~small & (np.bincount(deeper)[deeper] <= REGION)
        unit[fits] = top + deeper[fits]
        small |= fits
        top += int(deeper[-1]) + 1 if n else 0
    least = least_agreeing(similarity)
    hundredth = round(100 * similarity)
    s = np.stack([cols[f"s{i}"].view(np.uint64) for i in range(3)], axis=1) if n else np.zeros((0, 3), np.uint64)
    for k in range(1, min(REGION, n)):
        near = small[k:] & (unit[k:] == unit[:-k])
        if k <= WINDOW:
            near |= region[k:] == region[:-k]
        i = np.flatnonzero(near)
        if not len(i):
            continue
        x, y = cols["n"][i], cols["n"][i + k]
        i = i[100 * np.minimum(x, y) >= hundredth * np.maximum(x, y)]
        agree = agreement(s[i], s[i + k])
        i, agree = i[agree >= least], agree[agree >= least]
        a, b = cols["id"][i], cols["id"][i + k]
        yield {"a": np.minimum(a, b), "b": np.maximum(a, b), "agree": agree}


def _emit(kind: str, found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(next(iter(found.values()))), FOUND_ROWS):
        cols = {k: v[at : at + FOUND_ROWS] for k, v in found.items()}
        n = len(next(iter(cols.values())))
        table = {"kind": pa.array([kind] * n, pa.string())}
        for name, t in (("a", pa.int64()), ("b", pa.int64()), ("agree", pa.int32()), ("tree", pa.int32()), *((k, pa.int64()) for k in _NAMES[1:])):
            table[name] = pa.array(cols[name].astype(t.to_pandas_dtype())) if name in cols else pa.nulls(n, t)
        yield pa.RecordBatch.from_pydict(table)


def _columns(batches: list[pa.RecordBatch] | pa.Table) -> dict[str, np.ndarray]:
    table = batches if isinstance(batches, pa.Table) else pa.Table.from_batches(batches)
    return {k: table.column(k).to_numpy() for k in _NAMES}


def _take(cols: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in cols.items()}


def search(nodes: DataFrame, work: Workspace, similarity: float, ranges: int) -> DataFrame:
    """Table found, partitioned by kind: pair (a, b, agree), and large, the rows of regions over REGION nodes."""
    keys_by = ["tree", "k0", "k1", "k2", "id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        cols = _columns(held) if held else {}
        if not held or not len(cols["id"]):
            return
        for pairs in pairs_of(cols, similarity):
            yield from _emit("pair", pairs)
        region, sizes = regions_of(_changes(cols))
        yield from _emit("large", _take(cols, np.flatnonzero(sizes[region] > REGION)))
        place = np.arange(len(region))
        head = np.searchsorted(region, region, side="left")
        tail = np.searchsorted(region, region, side="right")
        opened = ((region == 0) & (place - head < REGION)) | ((region == region[-1]) & (tail - place <= REGION))
        yield from _emit("open", _take(cols, np.flatnonzero(opened)))

    def stitch(table: pa.Table) -> pa.Table:
        cols = _columns(table)
        order = np.lexsort((cols["id"], cols["k2"], cols["k1"], cols["k0"], cols["tree"]))
        cols = _take(cols, order)
        region, sizes = regions_of(_changes(cols))
        out = [batch for pairs in pairs_of(cols, similarity) for batch in _emit("pair", pairs)]
        out += _emit("large", _take(cols, np.flatnonzero(sizes[region] > REGION)))
        return pa.Table.from_batches(out) if out else pa.Table.from_batches(list(_emit("pair", {"a": np.zeros(1, np.int64), "b": np.zeros(1, np.int64), "agree": np.zeros(1, np.int64)}))).slice(0, 0)

    ordered = sorted_orders(nodes).repartitionByRange(ranges, *keys_by).sortWithinPartitions(*keys_by)
    found = work.table("found", ordered.mapInArrow(scan, _FOUND), ["kind"])
    edge = found.filter("kind = 'open'").select(*_NAMES)
    edge = edge.groupBy("tree", "k0", F.shiftright("k1", 32)).applyInArrow(lambda t: stitch(t), _FOUND)
    return found.filter("kind <> 'open'").unionByName(work.table("stitched", edge, ["kind"]))


def sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id, n and set (packed) of the documents whose ids the table ids may hold; a fixed-size filter lets a few others through."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    words = ids.select((at / 64).cast("long").alias("w"), (at % 64).cast("int").alias("bit")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for batch in words.toLocalIterator(prefetchPartitions=True):
        table[batch["w"]] = batch["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))
    hashed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("at"))

    def work(part: pa.RecordBatch) -> dict:
        at = part.column("at").to_numpy(zero_copy_only=False).astype(np.uint64)
        hit = ((shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        part = part.filter(pa.array(hit))
        values, ends = shingle_sets(part.column("text"), size)
        return {
            "doc_id": part.column("doc_id"),
            "n": pa.array(np.diff(ends).astype(np.int64)),
            "set": pa.array([pack(np.unique(values[a:b] >> np.uint64(7)), rising=True) for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
        }

    return map_slices(hashed.filter(F.col("doc_id").isNotNull()), work, "doc_id bigint, n bigint, set binary")


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs (a, b) whose full sets are similar enough."""
    hundredth = round(100 * similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y, nx, ny) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("set_a", "set_b", "n_a", "n_b")), strict=True)):
                both = np.concatenate([unpack(x), unpack(y)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common >= hundredth * (nx + ny - common)
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(good))

    side = lambda s: sets.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("set").alias(f"set_{s}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "n_b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "agree").unionAll(pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "agree"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _between(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """pairs with ca <> cb, the components of a and b."""
    a = comps.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = comps.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    named = pairs.join(a, "a", "left").join(b, "b", "left").withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})
    return named.filter("ca <> cb")


def link(nodes: DataFrame, docs: DataFrame, work: Workspace, size: int, similarity: float) -> DataFrame:
    """id and component of linked nodes (id, n, low); docs has the nodes' texts."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-nodes.count() * TREES // ROWS))
    found = search(nodes, work, similarity, ranges)
    candidates = work.table("pairs", found.filter("kind = 'pair' AND a <> b").groupBy("a", "b").agg(F.max("agree").alias("agree")))
    large = found.filter("kind = 'large'").select("tree", "k0", F.shiftright("k1", 32).alias("k1"), "id", "n", "s0", "s1", "s2")
    ids = candidates.select(F.explode(F.array("a", "b")).alias("id")).unionAll(large.select("id")).distinct()
    sets = work.table("sets", sets_of(docs, ids, size))
    best = _both_ways(candidates).groupBy("x").agg(F.max(F.struct("agree", (-F.col("y")).alias("o"))).alias("top")).select("x", (-F.col("top.o")).alias("y"))
    tried = work.table("tried1", _ordered(best))
    links = work.table("links1", confirm(tried, sets, similarity))
    comps = components(links, work, "cc1")

    one = lambda x, other: F.struct("agree", (-F.col(x)).alias("o"), (-F.col(other)).alias("p"))

    def exhaust(rest: DataFrame, comps: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """comps after all links among rest, and what was tried."""
        # of the candidates between a node and another component, the best first, for one link joins the components
        first = rest.groupBy("a", "cb").agg(F.max(one("a", "b")).alias("t")).select("a", (-F.col("t.p")).alias("b"))
        first = work.table(f"tried{k}", first.distinct())
        comps = _merged(comps, work.table(f"links{k}", confirm(first, sets, similarity)), work, f"cc{k}")
        last = work.table(f"tried{k + 1}", _between(rest.select("a", "b").join(first, ["a", "b"], "left_anti"), comps))
        return _merged(comps, work.table(f"links{k + 1}", confirm(last, sets, similarity)), work, f"cc{k + 1}"), first.unionAll(last.select("a", "b"))

    hubs = _hubs(large, links, comps, similarity, work)
    rest = candidates.select("a", "b", "agree").join(tried, ["a", "b"], "left_anti")
    rest = work.table("rest", _between(rest.unionByName(hubs).groupBy("a", "b").agg(F.max("agree").alias("agree")), comps))
    comps, tried2 = exhaust(rest, comps, 2)

    stuck = work.table("stuck", _split(large, comps))
    if stuck.isEmpty():
        return comps
    rare = _rarest(stuck, sets, similarity, ranges, work).join(tried.unionAll(tried2), ["a", "b"], "left_anti")
    return exhaust(work.table("rare", _between(rare, comps)), comps, 5)[0]



def _merged(comps: DataFrame, links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """comps after links join some of its components; only the components they touch are searched again."""
    if links.isEmpty():
        return comps
    between = _between(links, comps).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(between, work, name).select(F.col("id").alias("component"), F.col("component").alias("now"))
    moved = comps.join(joined, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    single = joined.join(comps.select(F.col("id").alias("component")), "component", "left_anti").select(F.col("component").alias("id"), F.col("now").alias("component"))
    return work.table(f"{name}-merged", moved.unionAll(single))


def _hubs(large: DataFrame, links: DataFrame, comps: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """a, b, agree: nodes of large regions with the region's HUBS best linked nodes, where these are of another component."""
    region = ["tree", "k0", "k1"]
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    members = work.table("members", large.distinct().join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")))
    split = members.groupBy(*region).agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select(*region)
    # each task keeps at most HUBS rows of a region before they are dealt out, so a large region's rows never meet in one
    best = F.row_number().over(Window.partitionBy(*region).orderBy(F.desc("degree"), "id"))
    top = members.join(degree, "id").withColumn("rn", best).filter(F.col("rn") <= HUBS)
    hub = F.struct((-F.col("id")).alias("o"), "component", "n", "s0", "s1", "s2")
    listed = top.groupBy(*region).agg(F.collect_list(hub).alias("hubs")).join(split, region)
    # each node gets its regions' distinct hubs in a list of at most TREES * HUBS, and only those that may be similar become rows
    own = F.struct("component", "n", "s0", "s1", "s2")
    near = members.join(listed, region).groupBy(F.col("id").alias("x")).agg(F.max(own).alias("m"), F.array_distinct(F.flatten(F.collect_list("hubs"))).alias("hubs"))
    hundredth = round(100 * similarity)

    def agree(h: Column) -> Column:
        differ = [F.col(f"m.s{i}").bitwiseXOR(h[f"s{i}"]) for i in range(3)]
        counts = [F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555))) for d in differ]
        return (F.lit(96) - counts[0] - counts[1] - counts[2]).cast("int")

    def may(h: Column) -> Column:
        sized = 100 * F.least(F.col("m.n"), h["n"]) >= hundredth * F.greatest(F.col("m.n"), h["n"])
        return (h["component"] != F.col("m.component")) & sized & (agree(h) >= least_agreeing(similarity))

    kept = F.transform(F.filter("hubs", may), lambda h: F.struct((-h["o"]).alias("y"), agree(h).alias("agree")))
    pairs = near.select("x", F.explode(kept).alias("p"))
    return pairs.select(F.least("x", "p.y").alias("a"), F.greatest("x", "p.y").alias("b"), "p.agree")


def _split(large: DataFrame, comps: DataFrame) -> DataFrame:
    """id, component, s0 to s2 of the nodes of large regions whose nodes fall into several components."""
    region = ["tree", "k0", "k1"]
    members = large.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = members.groupBy(*region).agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select(*region)
    return members.join(split, region).select("id", "component", "s0", "s1", "s2").distinct()


def _counts(sets: DataFrame) -> np.ndarray:
    """In how many of the sets a shingle is, at least, by its lowest COUNT_BITS bits; shingles with the same bits add up."""
    slices = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for raw in batch.column("set").to_pylist():
                np.add.at(total, (unpack(raw) & np.uint64(len(total) - 1)).astype(np.int64), 1)
        if total.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array(np.arange(slices, dtype=np.int32)), "data": pa.array([pack(x) for x in total.reshape(slices, -1)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << COUNT_BITS) // slices, np.uint64)
        for raw in table.column("data").to_pylist():
            total += unpack(raw)
        return pa.table({"slice": table.column("slice").slice(0, 1), "data": pa.array([pack(total)], pa.binary())})

    schema = "slice int, data binary"
    out = np.zeros((slices, (1 << COUNT_BITS) // slices), np.int64)
    for row in sets.select("set").mapInArrow(count, schema).groupBy("slice").applyInArrow(lambda t: add(t), schema).collect():  # 64 rows
        out[row["slice"]] = unpack(bytes(row["data"]))
    return out.ravel()


_RARE = "token bigint, low int, high int, block int, component bigint, id bigint, n int, place int, s0 bigint, s1 bigint, s2 bigint"


def _rarest(stuck: DataFrame, sets: DataFrame, similarity: float, ranges: int, work: Workspace) -> DataFrame:
    """a, b, agree: all pairs of nodes of different components that share one of their rarest shingles and may be similar.

    In any fixed order of shingles, sets x and y of at most x's size that are similar enough share one of x's first
    n - ceil(s n) + 1 and y's first n - ceil(2 s n / (1 + s)) + 1. The nodes of a common shingle are dealt into blocks, of
    which every two meet, so that none lie in one task.
    """
    hundredth = round(100 * similarity)
    own = work.table("own", sets.join(stuck, sets["doc_id"] == stuck["id"]).select("id", "component", "s0", "s1", "s2", "set"))
    shared = stuck.sparkSession.sparkContext.broadcast(_counts(own))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            lead = mix(ids.view(np.uint64))
            for at in range(0, batch.num_rows, 256):
                rows, token, place, size, count = [], [], [], [], []
                for i, raw in enumerate(batch.column("set").slice(at, 256).to_pylist(), at):
                    t = unpack(raw)
                    c = shared.value[(t & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)]
                    order = np.lexsort((t, c))[: len(t) + 1 + -hundredth * len(t) // 100]
                    p = np.flatnonzero(c[order] > 1)  # one that is in one set only is shared by none
                    token.append(t[order[p]])
                    place.append(p)
                    count.append(c[order[p]])
                    rows.append(np.full(len(p), i))
                    size.append(np.full(len(p), len(t)))
                row, n_blocks = np.concatenate(rows), -(-np.concatenate(count) // BLOCK)
                each = np.repeat(np.arange(len(row)), n_blocks)
                other = np.arange(len(each)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
                block = (lead[row[each]] % n_blocks[each].astype(np.uint64)).astype(np.int64)
                out = {"token": np.concatenate(token)[each].view(np.int64), "low": np.minimum(block, other), "high": np.maximum(block, other), "block": block, "n": np.concatenate(size)[each], "place": np.concatenate(place)[each]}
                kept = batch.select(["component", "id", "s0", "s1", "s2"]).take(pa.array(row[each]))
                yield pa.RecordBatch.from_pydict({k: kept.column(k) if k not in out else pa.array(out[k].astype(np.int64 if t == "bigint" else np.int32)) for k, t in (x.split() for x in _RARE.split(", "))})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            cols = {k: batch.column(k).to_numpy() for k in batch.schema.names}
            held = {k: np.concatenate([held[k], v]) for k, v in cols.items()} if held else cols
            if not len(held["id"]):
                continue
            last = np.ones(len(held["id"]), dtype=bool)
            for k in ("token", "low", "high"):
                last &= held[k] == held[k][-1]
            end = int(np.argmax(last))  # the last group may go on in the next batch
            yield from _meetings(_take(held, np.arange(end)), similarity)
            held = _take(held, np.arange(end, len(last)))
        if held:
            yield from _meetings(held, similarity)

    keys_by = ["token", "low", "high"]
    dealt = own.mapInArrow(deal, _RARE).repartition(ranges, *keys_by).sortWithinPartitions(*keys_by, "component")
    return work.table("met", dealt.mapInArrow(meet, "a bigint, b bigint, agree int")).groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _meetings(cols: dict[str, np.ndarray], similarity: float) -> Iterator[pa.RecordBatch]:
    """a, b, agree of whole groups of rows of _RARE, in the order of token, low, high and component."""
    size = len(cols["id"])
    if size < 2:
        return
    hundredth = round(100 * similarity)
    new = np.ones(size, dtype=bool)
    new[1:] = False
    for k in ("token", "low", "high"):
        new[1:] |= cols[k][1:] != cols[k][:-1]
    end = np.append(np.flatnonzero(new)[1:], size)[np.cumsum(new) - 1]
    new[1:] |= cols["component"][1:] != cols["component"][:-1]
    other = np.append(np.flatnonzero(new)[1:], size)[np.cumsum(new) - 1]  # where the row's group has its next component
    n = cols["n"].astype(np.int64)
    left = n - cols["place"]
    listed = cols["place"] <= n + -2 * hundredth * n // (100 + hundredth)
    s = np.stack([cols[f"s{i}"].view(np.uint64) for i in range(3)], axis=1)
    i = np.flatnonzero(other < end)
    k = 0
    while len(i):
        j = other[i] + k
        x, y = n[i], n[j]
        less = (x < y) | ((x == y) & (cols["id"][i] < cols["id"][j]))
        good = (cols["low"][i] == cols["high"][i]) | (cols["block"][i] != cols["block"][j])
        good &= (100 * np.minimum(x, y) >= hundredth * np.maximum(x, y)) & np.where(less, listed[i], listed[j])
        good &= (100 + hundredth) * np.minimum(left[i], left[j]) >= hundredth * (x + y)
        a, b = i[good], j[good]
        agree = agreement(s[a], s[b])
        near = agree >= least_agreeing(similarity)
        a, b = cols["id"][a[near]], cols["id"][b[near]]
        if len(a):
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)), "agree": pa.array(agree[near].astype(np.int32))})
        k += 1
        i = i[other[i] + k < end[i]]


def dedup(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "dedup")
    signed = work.table("signed", signatures(docs, size))
    same = ["f1", "f2", "n_shingles"]
    classes = work.table("classes", signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("id")))
    owner = classes.select("id", *(F.col(k).alias(f"of_{k}") for k in same))
    of_class = (F.col("doc_id") == F.col("id")) & (F.col("f1") == F.col("of_f1")) & (F.col("f2") == F.col("of_f2")) & (F.col("n_shingles") == F.col("of_n_shingles"))
    nodes = signed.join(owner, of_class).select("id", F.col("n_shingles").alias("n"), "low", "f1", "f2").dropDuplicates(["id", "f1", "f2"])
    comps = link(work.table("nodes", nodes), docs, work, size, similarity)
    # an id whose rows have several sets joins their classes
    several = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *same).distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("doc_id")
    doubled = signed.join(several, "doc_id").join(classes, same).select(F.col("doc_id").alias("a"), F.col("id").alias("b")).filter("a <> b")
    doubled = work.table("doubled", doubled.distinct())
    if not doubled.isEmpty():
        comps = components(comps.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(doubled), work, "cc4")
    comps = work.table("comps", comps.distinct())
    out = signed.drop("low").join(classes, same, "left").join(comps, "id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def query(docs: DataFrame) -> DataFrame:
    """op2: components of documents by shingles of four words."""
    return dedup(docs, size=4, similarity=0.8)


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM t WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (SELECT a, a FROM both_ways UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
m AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.r, t.doc_id) AS component_id, t.doc_id = coalesce(m.r, t.doc_id) AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN m ON m.doc_id = t.doc_id
"""
