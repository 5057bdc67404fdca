"""Near-dedup against all pairs of full sets, with copies, chains, stars in large regions, nulls and repeated rows."""

import random
import re

import pyarrow as pa
import pyarrow.compute
import pytest

from evidentia.llm import near_dedup
from evidentia.llm.components import components
from evidentia.plans.workspace import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, size=4):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def plain(rows, percent=80):
    sets = [(d, plain_set(t)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {d: find(d) for d in root}


def edited(words, edits, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"x{rng.randrange(10**9)}"
    return " ".join(out)


def corpus():
    rng = random.Random(8)
    texts = [None, "", " \n ", "one", "ONE", "one two", "one two three", "one two three four", "One Two three four"]
    for _ in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(40, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 5)):
            texts.append(edited(base, rng.randint(0, max(1, len(base) // 30)), rng))
    chain = [f"c{i}" for i in range(200)]
    for step in range(12):
        texts.append(" ".join(chain))
        chain[step * 15] = f"d{step}"
    hub = [f"h{i}" for i in range(400)]
    texts.append(" ".join(hub))
    texts += [edited(hub, 10, rng) for _ in range(70)]
    passage = [f"p{i}" for i in range(150)]
    texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(150)] + passage) for _ in range(45)]
    texts += [texts[12]] * 80 + ["long " + " ".join(f"l{i}" for i in range(30_000))] * 2
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    return rows + [rows[10], rows[20], (None, texts[10]), (None, None), (rows[30][0], texts[60])]


def test_components_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 7) for d, t in rows], "doc_id long, text string, id string, n long").repartition(5)
    got = near_dedup.query(docs).collect()
    assert len(got) == len(rows)
    want = plain(rows)
    sizes = sorted((d is None, d or 0, len(plain_set(t))) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sizes
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_another_similarity(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 970]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.dedup(docs, 4, 0.9).collect()} == plain(rows, 90)


def passages():
    """Texts of one shared passage and words of their own; every thirtieth has a pair of about 0.82, with which alone it is linked."""
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(160)]
    rows = []
    for i in range(1200):
        own = [f"u{i}_{k}" for k in range(38)]
        rows.append((i, " ".join(passage + own)))
        if i % 30 == 0:
            rows.append((5000 + rng.randrange(10**6), " ".join(passage + own[:17] + [f"v{i}_{k}" for k in range(21)])))
    return rows


def test_pairs_in_a_family_that_shares_a_passage(spark, monkeypatch):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain(rows)
    assert len(set(want.values())) == 1200
    for block in (near_dedup.BLOCK, 100):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert {r.doc_id: r.component_id for r in near_dedup.query(docs).collect()} == want


def test_pairs_of_dense_regions_come_in_bounded_batches(monkeypatch):
    class Taken(Exception):
        pass

    class Orders:
        def repartitionByRange(self, *_):
            return self

        sortWithinPartitions = table = repartitionByRange

        def mapInArrow(self, scan, _):
            raise Taken(scan)

    monkeypatch.setattr(near_dedup, "sorted_orders", lambda nodes: Orders())
    with pytest.raises(Taken) as taken:
        near_dedup.search(None, Orders(), 0.8, 1)
    rows, family = 32_000, 32
    ids = range(rows)
    order = {k: pa.array([0] * rows, pa.int64()) for k in near_dedup._NAMES} | {"k0": pa.array([i // family for i in ids]), "id": pa.array(ids), "n": pa.array([100] * rows)}
    batches = pa.Table.from_pydict(order).to_batches(512)
    found, most, held = set(), 0, pa.total_allocated_bytes()
    for batch in taken.value.args[0](iter(batches)):
        assert batch.num_rows <= 1 << 16
        most = max(most, pa.total_allocated_bytes() - held)
        pairs = batch.filter(pa.compute.equal(batch.column("kind"), "pair"))
        found |= set(zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True))
    assert found == {(a, b) for a in ids for b in range(a + 1, a - a % family + family)}
    assert most < 16 << 20


def test_sets_of_a_full_batch():
    texts = [f"a b c d e{i}" for i in range(512)]
    values, at = near_dedup.shingle_sets(pa.array(texts), 4)
    assert len(at) == 513 and set(at[1:] - at[:-1]) == {2} and len(set(values.tolist())) == 513


def test_empty_table(spark):
    assert near_dedup.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 540)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "cc-test")).collect()
    assert {r["id"]: r["component"] for r in got} == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
