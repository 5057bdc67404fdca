"""Packing: ids as the tokenizers library makes them, whole coverage, gapless places, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from evidentia.llm import packing
from evidentia.plans.workspace import Workspace

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "<|endoftext|> it's naïve 漢字 😀", "Of onons thndou erti the. " * 900, "short one", "short one", "x" * 5000, "a  b\n\n c " * 50]


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(FILE)
    out.encode_special_tokens = True
    return out


def test_pieces_and_places(spark, library):
    docs = spark.createDataFrame([(i if i != 4 else None, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, item string")
    rows = packing.query(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert len(by_doc) == len(TEXTS)
    for doc_id, own in by_doc.items():
        ids = library.encode(TEXTS[4 if doc_id is None else doc_id] or "", add_special_tokens=False).ids + [0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own[:-1])]).tolist() and sum(r.length for r in own) == len(ids)
        assert all(r.length == 2048 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 2048)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.query(docs.limit(0)).count() == 0


def test_few_sequences_over_many_blocks(spark):
    rng = random.Random(3)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)] + [700] * 900
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    placed = packing.pack(items, Workspace(spark, "pack-test"), block_items=500).collect()
    assert sorted(r["item"] for r in placed) == list(range(len(lengths)))
    fill = defaultdict(int)
    for r in placed:
        fill[r.sequence_id] += lengths[r["item"]]
    least = -(-sum(lengths) // 2048)
    assert max(fill.values()) <= 2048 and len(fill) <= least + 3


def test_crossover_keeps_every_item_once():
    rng = random.Random(5)
    lengths = sorted((rng.randint(1, 1500) for _ in range(300)), reverse=True)
    own = packing.Island(lengths, 1)
    jumbled = packing.best_fit(lengths, rng.sample(range(300), 300), [], 2048)
    for child in (own.cross(own.people[0], jumbled), own.mutate(jumbled)):
        assert sorted(x for b in child for x in b) == list(range(300))
        assert max(sum(lengths[x] for x in b) for b in child) <= 2048
    assert len(own.evolve()) <= len(packing.best_fit(lengths, list(range(300)), [], 2048))


def test_items_that_never_fit_together(spark):
    items = spark.createDataFrame([(i, 1500) for i in range(60)], "item long, length long")
    assert len({r.sequence_id for r in packing.pack(items, Workspace(spark, "pack-test"), block_items=10).collect()}) == 60


@pytest.mark.parametrize(("n", "parts"), [(1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]), (4096, [(0, 2048), (2048, 2048)])])
def test_cuts(n, parts):
    assert packing.cut(n) == parts


@pytest.mark.parametrize("text", [" " * 3_000_000, "\n" * 1_000_000, "a" + " \n" * 700_000 + "b", "x" * 300_000])
def test_very_long_runs_have_the_librarys_ids(library, text):
    assert packing.codec(FILE)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def triplets(rng, bins, capacity):
    """Lengths of which three at a time fill a bin."""
    out = []
    for _ in range(bins):
        a = rng.randint(capacity * 38 // 100, capacity * 49 // 100)
        b = rng.randint((capacity - a) * 42 // 100, (capacity - a) // 2)
        out += [a, b, capacity - a - b]
    return sorted(out, reverse=True)


def test_search_beats_best_fit_decreasing():
    rng = random.Random(11)
    saved = 0
    for seed in range(4):
        lengths = triplets(rng, 60, 2048)
        first = len(packing.best_fit(lengths, list(range(len(lengths))), [], 2048))
        own = packing.Island(lengths, seed)
        found = own.evolve()
        assert sorted(x for b in found for x in b) == list(range(len(lengths))) and max(sum(lengths[x] for x in b) for b in found) <= 2048
        assert own.least == 60 <= len(found) <= first
        saved += first - len(found)
    assert saved >= 20


def test_least_bins_is_a_bound_and_sees_big_pieces():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 100) for _ in range(rng.randint(1, 9))), reverse=True)
        order = min(len(packing.best_fit(lengths, rng.sample(range(len(lengths)), len(lengths)), [], 100)) for _ in range(200))
        assert -(-sum(lengths) // 100) <= packing.least_bins(lengths, 100) <= order
    assert packing.least_bins([1500] * 60, 2048) == 60
