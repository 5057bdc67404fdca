"""Katz backoff against a plain evaluation with dictionaries, and sums of probabilities."""

import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from evidentia.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class Plain:
    """All contexts in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [None] + [Counter() for _ in range(order)]
        for t in texts:
            w = [None] * (order - 1) + WORD.findall(lowered(t)) + ["\n"]
            for n in range(1, order + 1):
                for i in range(order - 1, len(w)):
                    self.counts[n][tuple(w[i - n + 1 : i + 1])] += 1
        tally = [None] + [Counter(c.values()) for c in self.counts[1:]]
        self.d = [None] + [katz.discounts(np.array([t[r] if r else 0 for r in range(katz.CUTOFF + 2)])) for t in tally[1:]]
        self.total = sum(self.counts[1].values())
        self.after = [None] + [defaultdict(dict) for _ in range(order)]
        for n in range(1, order + 1):
            for g, c in self.counts[n].items():
                self.after[n][g[:-1]][g[-1]] = c
        self.memo = {}

    def disc(self, n, c):
        return c * (self.d[n][c] if c <= katz.CUTOFF else 1.0)

    def weights(self, h):
        n = len(h) + 1
        if h not in self.memo:
            seen = self.after[n][h]
            total, kept = sum(seen.values()), sum(self.disc(n, c) for c in seen.values())
            scale = min(1.0, total * total / ((total + 0.5) * kept))
            lower = sum(self.p(w, h[1:]) for w in seen) if h else 0.0
            self.memo[h] = scale / total, (1 - scale * kept / total) / (1 - lower)
        return self.memo[h]

    def p(self, w, h):
        n = len(h) + 1
        if h not in self.after[n]:
            return self.p(w, h[1:]) if h else 1.0
        f, alpha = self.weights(h)
        c = self.after[n][h].get(w, 0)
        return f * self.disc(n, c) if c else alpha * (self.p(w, h[1:]) if h else 1.0)

    def score(self, t):
        w = [None] * (self.order - 1) + WORD.findall(lowered(t)) + ["\n"]
        return sum(log10(self.p(w[i], tuple(w[i - self.order + 1 : i]))) for i in range(self.order - 1, len(w)))


def corpus():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(120)] + ["The", "thé", "a\x1cb"]
    weights = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, int(n), p=weights / weights.sum())) for n in rng.integers(1, 60, 150)]
    return [*texts, None, "", " \n\t", "unseenword the w1", texts[0], texts[0], "w1 " * 3000]


@pytest.mark.parametrize(("order", "options"), [(2, {}), (3, {}), (2, {"part_grams": 200, "hot": 30}), (3, {"part_grams": 200, "hot": 20})])
def test_scores_equal_plain_evaluation(spark, order, options):
    texts = corpus()
    docs = spark.createDataFrame([(i if i != 5 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(3)
    got = {r.doc_id: r for r in katz.query(docs, order=order, **options).collect()}
    assert len(got) == len(texts)
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10 == 0}
    taught = [t for i, t in enumerate(texts) if i not in held and i != 5]
    plain = Plain(taught, order)
    known = plain.counts[1]
    for doc_id, r in got.items():
        i = 5 if doc_id is None else doc_id
        w = WORD.findall(lowered(texts[i])) + ["\n"]
        assert r.held_out == (doc_id in held) and r.n_tokens == len(w) and r.train_tokens == plain.total
        assert r.n_known == sum((x,) in known for x in w)
        base = sum(log10((known[(x,)] + 0.1) / (plain.total + 0.1 * (len(known) + 1))) for x in w)
        assert abs(r.base_score - base) < 1e-7 * max(1, abs(base))
        assert abs(r.score - plain.score(texts[i])) < 1e-7 * max(1, abs(r.score))


def test_query_scores_by_trigrams(spark):
    texts = [t or "" for t in corpus()]
    held = {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10 == 0}
    plain = Plain([t for i, t in enumerate(texts) if i not in held], 3)
    for r in katz.query(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert abs(r.score - plain.score(texts[r.doc_id])) < 1e-7 * max(1, abs(r.score))


def test_each_context_sums_to_one():
    plain = Plain([t for t in corpus() if t], 2)
    words = [g[0] for g in plain.counts[1]]
    for h in [(w,) for w in words[:40]] + [(None,), ("never",)]:
        assert abs(sum(plain.p(w, h) for w in words) + plain.p("never seen", h) - 1) < 1e-9


def test_no_rows_and_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert katz.query(empty).count() == 0
    (got,) = katz.query(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert (got.n_known, got.train_tokens, got.score) == (0, 0, 0.0)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for a in (np.zeros(0, np.uint64), np.arange(5), rng.integers(0, 1 << 63, 100).astype(np.uint64), np.array([1 << 40, 3])):
        assert (katz.unpack(katz.pack(a)) == a).all()
    a = np.sort(rng.integers(0, 1 << 63, 100).astype(np.uint64))
    assert (katz.unpack(katz.pack(a, rising=True)) == a).all()
    b = rng.random(9)
    assert (katz.unpack(katz.pack(b)) == b).all()
    assert katz.unframe(katz.frame(b"", b"ab")) == [b"", b"ab"]
