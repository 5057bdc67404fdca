"""Each stage of the pipeline against plain decisions on its own input, and the stages together."""

import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from evidentia.llm import secret_scan  # noqa: E402

SYLLABLES = {"aa": ["the", "ing", "ed", "ow", "er"], "bb": ["eau", "oui", "çon", "ré", "ment"]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        lang = "aa" if i % 2 else "bb"
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(40, 120))]
        bad = i % 4 == 3
        if bad:
            words.insert(rng.randrange(len(words)), "villainous")
        rows.append([i, " ".join(words), lang, f"src{i % 3}", 0])
        labels.append((i, 1, int(bad)))
    rows[100][1] = rows[20][1]
    rows[102][1] = rows[20][1] + " ouioui"
    rows[104][1] = "12345 !!! 678"
    rows[106][1] = None
    rows[108][1] += " password = hunter2hunter2hunter2"
    rows = [(*r[:4], len(r[1] or ""), "mine") for r in rows]
    to = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{to}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{to}/labels.parquet")
    return str(to)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], ({104, 106}, {i for i in range(400) if i % 4 == 3}, {100, 102})):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert ids(docs) - ids(out) == gone, name
        docs = out
    out = corpus_pipeline.secrets(spark, docs, folder)
    assert out.columns == docs.columns
    for r in out.collect():
        want = re.sub(r"password = \w+", secret_scan.MASK, texts[r.doc_id])
        assert r.text == want and r.n_chars == len(want) and r.score == "mine"


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {i for i in range(400) if i % 4 != 3} - {100, 102, 104, 106}
    assert all(r.length <= 2048 for r in got)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_no_rows(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, folder).count() == 0
