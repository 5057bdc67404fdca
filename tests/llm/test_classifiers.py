"""Language ID and toxicity: held-out accuracy, naive evaluation of the models, and odd rows; and the word scans below them."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evidentia.llm import language_id, toxicity
from evidentia.llm.textscan import ALNUM, SPACED, Words, utf8

PATTERNS = ((SPACED, re.compile(r"[^\x20\x09-\x0D]+")), (ALNUM, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é漢 \t\n\r\x0b\x0c\x1c.-", max_size=30)), max_size=5))
def test_words_equal_the_patterns(texts):
    body, at = utf8(pa.array(texts, pa.string()))
    for kept, pattern in PATTERNS:
        words = Words(body, at, kept)
        raw = bytes(body)
        got = [[lowered(raw[a:b].decode()) for a, b in zip(words.starts[i:j], words.ends[i:j])] for i, j in zip(words.of, words.of[1:])]
        assert got == [pattern.findall(lowered(t)) for t in texts]
        flat = [w for ws in got for w in ws]
        assert len(words.hashes) == len(flat) and len(set(words.hashes.tolist())) == len(set(flat))
        assert len(set(zip(flat, words.hashes.tolist()))) == len(set(flat))


SYLLABLES = {"aa": ["the", "ing", "ed", "ow", "er", "sh"], "bb": ["eau", "oui", "çon", "ré", "ment", "aux"], "cc": ["sch", "ung", "über", "ein", "keit", "ich"]}


def corpus(n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(5, 40))), lang))
    return rows


def test_languages(spark):
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", "bb"), (None, "the ing ed shing", None), (1004, "ouiçon " * 30_000, "bb"), (1005, "eau oui ment", None)]
    rows = corpus() + odd + corpus()[:3]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = language_id.query(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[None].lang_pred == "aa" and not by[None].held_out and by[1004].lang_pred == by[1005].lang_pred == "bb"
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert len(held) > 50 and all(r.lang_pred == sorted(SYLLABLES)[r.doc_id % 3] and 0 <= r.score <= 1 for r in held)
    assert language_id.query(docs.limit(0)).count() == 0
    untaught = language_id.query(docs.filter("doc_id < 5").selectExpr("doc_id", "text", "cast(null as string) AS lang"))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_scores_equal_a_plain_naive_bayes(spark):
    rows = corpus(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, matrix = language_id.train(docs, buckets=4096)
    counts = {x: Counter() for x in languages}
    for _, text, lang in rows:
        counts[lang].update(language_id.grams(pa.array([text]), 4096)[0].tolist())
    for i, x in enumerate(languages):
        total = sum(counts[x].values())
        for b in (0, 7, 99, 4000):
            assert matrix[i, b] == pytest.approx(np.log((counts[x][b] + 0.5) / (total + 0.5 * 4096)), rel=1e-5)
    text = rows[0][1]
    best, sure = language_id.scores(pa.array([text]), matrix)
    sums = matrix[:, -1] + matrix[:, language_id.grams(pa.array([text]), 4096)[0]].sum(axis=1)
    assert best[0] == sums.argmax() and sure[0] == pytest.approx(1 / np.exp(sums - sums.max()).sum())


def test_grams_stay_inside_their_text():
    hashed, of = language_id.grams(pa.array(["ab", None, "", "b", "xay"]), 1 << 16)
    alone = [language_id.grams(pa.array([t]), 1 << 16)[0].tolist() for t in ("ab", "b", "xay")]
    assert [sorted(hashed[of == i].tolist()) for i in (0, 3, 4)] == [sorted(a) for a in alone] and not (of == 1).any()


def test_more_languages_get_fewer_buckets():
    assert language_id.buckets_for(4) == language_id.BUCKETS and language_id.buckets_for(10_000) * 10_000 <= language_id.MODEL_CELLS
    with pytest.raises(ValueError, match="bound"):
        language_id.buckets_for(10**7)


def labelled(n=1200):
    """Toxic if an insult meets a group's name: neither word tells alone."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(10, 40))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        for word, there in (("scoundrel", insult), ("martians", group)):
            if there:
                words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    return rows, labels


def test_the_machine_learns_what_two_words_mean_together(spark):
    rows, labels = labelled()
    odd = [(5000, None), (5001, ""), (None, "scoundrel martians"), (5003, "w1 " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows + odd + rows[:2]], "doc_id long, text string, score string, predicted int")
    marks = spark.createDataFrame([*labels, (5000, None), (None, 1), (5001, 7), labels[0]], "doc_id long, toxic int")
    got = toxicity.query(docs, marks).collect()
    assert len(got) == len(rows) + len(odd) + 2
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score and by[5000].predicted == 0 and by[None].predicted == 1


def test_pairwise_part_equals_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    w, v = rng.normal(size=6), rng.normal(size=(6, 3))
    of, at = np.array([0, 0, 0, 2, 2]), np.array([0, 2, 5, 1, 3])
    got, _ = toxicity.forward(of, at, 3, 0.5, w, v)
    for i in range(3):
        own = at[of == i]
        assert got[i] == pytest.approx(0.5 + w[own].sum() + sum(v[a] @ v[b] for k, a in enumerate(own) for b in own[k + 1 :]))


@pytest.mark.parametrize("marks", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)]])
def test_labels_of_one_kind_or_none(spark, marks):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
    got = toxicity.predict(docs, toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int")), ["doc_id"]).collect()
    assert {r.predicted for r in got} == {int(bool(marks) and marks[0][1])}
    assert toxicity.predict(docs.limit(0), toxicity.train(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")), ["doc_id"]).count() == 0


def test_a_bounded_sample_is_the_same_by_either_way(spark):
    rows, labels = labelled(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    from pyspark.sql import functions as F

    few = {r.doc_id for r in marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(100).collect()}
    model = toxicity.train(docs, marks, rows=100)
    alone = toxicity.train(docs, marks.filter(F.col("doc_id").isin(*few)), rows=10_000)
    assert (model.terms == alone.terms).all() and model.w0 == alone.w0 and (model.w == alone.w).all()


def paired(n, seed):
    """A slur and a group's name are toxic only beside their own counterpart: no sum of single weights parts these texts."""
    rng = random.Random(seed)
    texts, y = [], []
    for _ in range(n):
        words = [f"plain{rng.randrange(300)}" for _ in range(20)]
        a, b = rng.randrange(2), rng.randrange(2)
        kind = rng.random()
        if kind < 0.5:
            words += [f"slur{a}", f"group{b}"]
        elif kind < 0.7:
            words.append(rng.choice([f"slur{a}", f"group{b}"]))
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(float(kind < 0.5 and a == b))
    return pa.array(texts), np.array(y)


def test_the_pairwise_part_finds_what_single_weights_miss():
    texts, y = paired(3000, 1)
    fresh, truth = paired(1000, 2)
    right = {pairs: np.mean((toxicity.fit(*toxicity.terms(texts), y, pairs=pairs).score(fresh) >= 0.5) == truth) for pairs in (True, False)}
    assert right[True] > 0.97 and right[False] < 0.9


def test_terms_that_matter_only_beside_others_are_kept():
    rng = random.Random(3)
    texts, y = [], []
    for i in range(4000):
        insult, group = i % 10 == 0, rng.random() < 0.5
        texts.append(" ".join([*(f"w{rng.randrange(400)}" for _ in range(12)), *["insult"] * insult, *["group"] * group]))
        y.append(float(insult and group))
    of, bucket = toxicity.terms(pa.array(texts))
    seen, place = np.unique(bucket, return_inverse=True)
    chosen = toxicity.choose(of, bucket, np.array(y), np.ones(len(y), bool))
    named = {w: toxicity.terms(pa.array([w]))[1][0] for w in ("insult", "group")}
    assert set(named.values()) <= set(chosen.tolist())


def test_repeated_ids_do_not_swell_the_sample(spark):
    from pyspark.sql import functions as F

    rows, labels = labelled(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    once, often = toxicity.train(docs, marks), toxicity.train(docs.withColumn("text", F.explode(F.array("text", "text", "text"))), marks)
    assert (once.terms == often.terms).all() and (once.w == often.w).all() and once.w0 == often.w0


def test_the_task_that_fits_gets_chosen_terms_only(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows, labels = labelled(400)
    rows = [(i, text + "".join(f" rare{i}x{k}" for k in range(1500))) for i, text in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    handed, real = [], type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda self, *by: handed.append(self) or real(self, *by))
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    (lists,) = (name for name, kind in handed[-1].dtypes if kind.startswith("array"))
    assert handed[-1].agg(F.max(F.size(lists))).first()[0] <= len(model.terms) < 100
    want = toxicity.fit(*toxicity.terms(pa.array([text for _, text in rows])), np.array([float(toxic) for _, toxic in labels]))
    assert (model.terms == want.terms).all() and (model.w == want.w).all() and (model.v == want.v).all() and model.w0 == want.w0
