"""Licence scans against plain searches and media shards against exact round trips."""

import hashlib
import re
import tarfile
import zlib
from pathlib import Path

from evidentia.llm import license_scan, media_store
from evidentia.plans.workspace import Workspace

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None,
    "",
    "CC BY cc-by; cc by cc by.",
    "GNU General Public License, all rights\nreserved. accby cc byte",
    "é cc\x1cby ñ Released under the MIT License.",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nmore",
    "SPDX-License-Identifier: MIT AND",
    "SPDX-License-Identifier: Foo-1.0 OR Bar",
    "all rights reserved " * 3000,
    "word " * 20000,
]
SCHEMA = "doc_id long, text string, labels string, feature int"


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i if i != 3 else None, t, "mine", 1) for i, t in enumerate(texts)] + [(0, texts[0], "mine", 1)] if texts else [], SCHEMA)


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = []
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_equal_plain_search(spark):
    got = license_scan.query(frame(spark)).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        text = TEXTS[3 if r.doc_id is None else r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text)
        assert set(r.base_labels.split(",")) <= {"", *r.labels.split(",")} and 0 <= r.score <= 1
    by = {r.doc_id: r.labels for r in got}
    assert by[4] == "cc-by,mit"
    assert by[5] == "apache,exception,gpl,mit"
    assert by[6] == "unparsed" and by[7] == "unknown"
    assert license_scan.query(frame(spark, [])).count() == 0


def test_expressions_bind_and_before_or_and_with_first():
    assert license_scan.postfix("a OR b AND c WITH d rest") == ["a", "b", "c", "d", "with", "and", "or"]
    assert license_scan.postfix("((a))") == ["a"]
    assert license_scan.postfix("(a") is None and license_scan.postfix("") is None and license_scan.postfix("AND a") is None
    assert license_scan.evaluate(license_scan.postfix("MIT OR Zed")) == ({"mit"}, True)
    assert license_scan.evaluate(license_scan.postfix("MIT AND Zed")) == ({"mit"}, False)


def test_payloads_come_back_from_shards(spark):
    work = Workspace(spark, "media-test")
    index = media_store.store(frame(spark), work)
    described = media_store.metadata(index, work)
    got = media_store.read_back(described, work).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        raw = (TEXTS[3 if r.doc_id is None else r.doc_id] or "").encode()
        payload = raw + b"\xff" * (576 - len(raw) % 576 if len(raw) % 576 or not raw else 0)
        assert len(payload) % 576 == 0 and r.n_bytes == len(raw) and r.payload_bytes == len(payload)
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        media = media_store.to_png(payload)
        assert r.media_bytes == len(media) and r.media_sha256 == hashlib.sha256(media).hexdigest()
    assert {(r.width, r.bits) for r in described.collect()} == {(24, 8)}
    shards = list(Path(work.path.removeprefix("file://"), "shards").iterdir())
    names = [m.name for s in shards for m in tarfile.open(s).getmembers()]
    assert {n.removesuffix(".png") for n in names} == {r.media_sha256 for r in got}
    assert media_store.query(frame(spark, [])).count() == 0


def test_equal_texts_share_a_member(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(50)], "doc_id long, text string").coalesce(1)
    index = media_store.store(docs, Workspace(spark, "media-test"))
    assert index.select("shard", "offset").distinct().count() == 1
