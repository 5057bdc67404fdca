"""Likelihoods, geometry, page operators, sources and the stream, against plain evaluation."""

import itertools
import json

import numpy as np
import pytest

from evidentia import dims
from evidentia.config import EngineConfig
from evidentia.operators import channels as H
from evidentia.operators import geometry as X
from evidentia.operators import pages as G
from evidentia.plans.ship import ship
from evidentia.sources import packets, rows, words
from evidentia.streaming import packets as stream


def test_ctc_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(3)
    p = rng.random((4, 3))
    p /= p.sum(axis=1, keepdims=True)
    for labels in ([1, 2], [1, 1], [2], []):
        total = 0.0
        for path in itertools.product(range(3), repeat=4):
            spelt = [k for k, _ in itertools.groupby(path)]
            if [k for k in spelt if k] == labels:
                total += np.prod([p[t, k] for t, k in enumerate(path)])
        assert H.ctc_log_likelihood(np.log(p), labels) == pytest.approx(np.log(total))
    assert H.ctc_log_likelihood(np.log(p), [1] * 6) == -1e30


def test_gate(spark):
    data = [("a", "X", -1.0), ("a", "Y", -1.4), ("a", H.NONE, -2.0), ("b", "X", -1.0), ("b", "Y", -1.1), ("c", "X", -4.0), ("d", "X", -1.0), ("d", H.NONE, -0.5), ("e", "X", -1.0)]
    got = H.gate(spark.createDataFrame(data, "k string, value string, score double"), ("k",)).collect()
    assert {r.k for r in got} == {"a", "e"}
    assert [r.k for r in H.gate(spark.createDataFrame(data, "k string, value string, score double"), ("k",), barred=("X",)).collect()] == []


def test_theil_sen_equals_numpy(spark):
    rng = np.random.default_rng(1)
    data = [("a", float(x), float(2 * x + 3 + rng.normal())) for x in range(100)] + [("b", 1.0, 5.0)]
    got = {r.k: (r.slope, r.intercept) for r in X.theil_sen(spark.createDataFrame(data, "k string, x double, y double"), "k").collect()}
    x, y = np.array([d[1:] for d in data if d[0] == "a"]).T
    pick = np.linspace(0, 99, 60).astype(int)
    i, j = np.triu_indices(60, 1)
    slope = np.median((y[pick][i] - y[pick][j]) / (x[pick][i] - x[pick][j]))
    assert got["a"] == pytest.approx((slope, np.median(y[pick] - slope * x[pick]))) and got["b"] == (0.0, 5.0)


def test_range_join_equals_all_pairs(spark):
    rng = np.random.default_rng(5)
    a = [(int(k), float(x), float(x + w)) for k, x, w in zip(rng.integers(0, 3, 80), rng.random(80) * 300, rng.random(80) * 90)]
    b = [(int(k), float(x), float(x + w)) for k, x, w in zip(rng.integers(0, 3, 60), rng.random(60) * 300, rng.random(60) * 90)]
    got = X.range_join(spark.createDataFrame(a, "k int, lo double, hi double"), spark.createDataFrame(b, "k int, r_lo double, r_hi double"), ("k",), 25.0)
    want = [(k, lo, hi, p, q) for k, lo, hi in a for c, p, q in b if c == k and lo < q and hi > p]
    assert sorted(map(tuple, got.select("k", "lo", "hi", "r_lo", "r_hi").collect())) == sorted(want)


def test_matching_keeps_most_pairs_then_least_residual():
    assert X.match_endpoints([0, 10, 20], [1, 9, 21], 0.0, 2.0) == [(0, 0), (1, 1), (2, 2)]
    assert X.match_endpoints([0, 1], [1], 0.0, 1.5) == [(1, 0)]
    assert X.match_endpoints([], [1], 0.0, 1.0) == []


def test_offset_path_is_the_cheapest():
    rng = np.random.default_rng(2)
    scores, states = rng.random((4, 3)), np.array([-1, 0, 1])

    def cost(path):
        total = -scores[0, path[0]] + 0.064 * abs(states[path[0]]) - (1.0 if states[path[0]] == 0 else 0)
        for t in range(1, 4):
            a, b = states[path[t - 1]], states[path[t]]
            total += 0.018 * abs(a - b) + 0.12 * (a != b) - scores[t, path[t]] * (1.5 + min(1.0, 2 * scores[t].max())) + 0.004 * abs(b)
        return total

    best = min(itertools.product(range(3), repeat=4), key=cost)
    assert X.offset_path(scores, states).tolist() == [states[i] for i in best]


def test_periods_and_fragments():
    assert X.periods(np.tile([5, 0, 0, 0], 8))[0] == 4 and X.periods(np.zeros(20)) == []
    pixels = np.arange(24, dtype=np.uint8).reshape(4, 6)
    moved, source, bare = X.shift_fragments(pixels, [(0, 2, 0), (2, 4, 2)])
    assert (moved[:2] == pixels[:2]).all() and (moved[2:, 2:] == pixels[2:, :-2]).all() and bare[2:, :2].all() and (source[2:, :2] == -1).all()
    with pytest.raises(ValueError, match="tile"):
        X.shift_fragments(pixels, [(0, 2, 0), (3, 4, 2)])
    profile = np.array([0, 0, 5.0, 9, 5, 0, 0, 0])
    assert X.soft_overlap(np.roll(profile, 2), profile, 3)[0] == 2


def test_rows_group_around_their_first_span(spark):
    spans = spark.createDataFrame([("c", 0, float(y), float(x)) for y, x in ((0, 1), (3, 0), (6, 2), (9, 5))], "case_id string, page_index int, y double, x double")
    got = sorted((r.y, r.row) for r in G.rows_of(spans).collect())
    assert got == [(0, 0), (3, 0), (6, 1), (9, 1)]  # 6 is near 3, but not the row's first


def test_stamps_need_size_shape_and_filling():
    mask = np.zeros((200, 300), bool)
    mask[50:80, 40:160:3] = True
    mask[150:153, 10:13] = True
    assert [(x, y) for x, y, *_ in H.stamp_boxes(mask)] == [(40, 50)]
    assert H.stamp_boxes(np.zeros((20, 20), bool)) == []


def plain_stamps(mask, reach=4):
    """Boxes by closing and flooding cell by cell; places outside count as clear when marks grow and as set when they shrink."""
    tall, wide = mask.shape
    around = lambda y, x: ((v, u) for v in range(max(0, y - reach), min(tall, y + reach + 1)) for u in range(max(0, x - reach), min(wide, x + reach + 1)))
    grown = {c for y, x in zip(*map(list, np.nonzero(mask)), strict=True) for c in around(int(y), int(x))}
    open_cells = {(y, x) for y, x in grown if all(c in grown for c in around(y, x))}
    out = []
    while open_cells:
        todo = [open_cells.pop()]
        part = []
        while todo:
            y, x = todo.pop()
            part.append((y, x))
            next_to = {(y + v, x + u) for v in (-1, 0, 1) for u in (-1, 0, 1)} & open_cells
            open_cells -= next_to
            todo += next_to
        ys, xs = zip(*part, strict=True)
        w, h, n = max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, sum(bool(mask[c]) for c in part)
        if n >= 400 and w >= 40 and 1.5 <= w / h <= 8 and 0.08 <= n / (w * h) <= 0.8:
            out.append((min(xs), min(ys), w, h, n))
    return sorted(out)


def test_stamp_detector_reads_every_row(spark, tmp_path):
    from evidentia import catalogue

    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=4).tolist() for i in (0, 1, 7, 49, 50, 51, 123)} | {99: [0.0, 0.0, 1.0, 1.0]}
    spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in catalogue.queries()["stamp_detector"](spark, str(tmp_path)).collect())
    want = []
    for i, vector in vectors.items():
        mask = np.zeros((160, 240), bool)
        x, y = (int(abs(v) * 400) % 100 for v in vector[:2])
        mask[y : y + 24, x : x + 100 : 2] = True
        mask[150:156, :6] = True
        want += [(i, *box) for box in plain_stamps(mask)]
    assert len(want) >= len(vectors) and got == sorted(want)


def test_digit_vote_abstains(spark):
    def vote(*reads):
        frame = spark.createDataFrame([("c", p, g) for p, g in reads], "case_id string, page_index int, group string")
        return [r.sponsor_id for r in G.digit_vote(frame).collect()]

    assert vote((0, "1234"), (1, "1234"), (2, "1934")) == ["SPN-1234"]
    assert vote((0, "1234"), (0, "1235")) == [] and vote((0, "1234"), (1, "1235")) == []
    assert vote((0, "1234"), (1, "1234"), (2, "5678")) == [] and vote((0, "0007"), (1, "0007")) == []
    assert vote((0, "12X4"), (1, "12X4"), (2, "1234")) == []


def test_packets_and_case_ids(spark, tmp_path):
    for name in ("MIB-000001.pdf", "MIB-00002.pdf", "other.pdf", "MIB-000003.txt"):
        (tmp_path / name).write_bytes(b"%PDF")
    assert [r.stem for r in packets.scan(spark, str(tmp_path)).collect()] == ["MIB-000001"]
    spans = spark.createDataFrame([("scan7", 1, "Packet MIB-000009 / page 2"), ("scan7", 0, "Packet MIB-000008 / page 1"), ("MIB-000001", 0, "Packet MIB-000002 / page 1")], "stem string, page_index int, text string")
    stems = spark.createDataFrame([("scan7",), ("MIB-000001",), ("none",)], "stem string")
    assert {r.stem: r.case_id for r in packets.case_ids(stems, spans).collect()} == {"scan7": "MIB-000008", "MIB-000001": "MIB-000001", "none": "none"}


def test_rows_round_trip_with_sorted_keys(spark, tmp_path):
    one = {"case_id": "MIB-000001", **dims.DEFAULTS, "risk_flags": "none", "adjudication": "DENIED", "confidence": 0.5}
    frame = spark.createDataFrame([tuple(one.values()) + ("R1", 0.1)], rows.DEV)
    rows.write_rows(frame, str(tmp_path / "out"))
    (file,) = (f for f in (tmp_path / "out").glob("*.json") if f.stat().st_size)
    keys = list(json.loads(file.read_text()))
    assert keys == sorted(keys) and "_path" not in keys
    assert rows.read_rows(spark, str(tmp_path / "out")).first().asDict() == one
    cases = spark.createDataFrame([("MIB-000001",), ("MIB-000002",)], "case_id string")
    assert rows.complete(frame.unionAll(frame), cases).first().asDict() == {"missing": 1, "doubled": 1}
    (tmp_path / "labels.csv").write_text("adjudication,case_id," + ",".join(dims.FIELD_WEIGHTS) + "\nDENIED,MIB-000001," + ",".join("x" * len(dims.FIELD_WEIGHTS)) + "\n")
    assert rows.read_labels(spark, str(tmp_path / "labels.csv")).first().adjudication == "DENIED"


def test_word_sources(spark):
    data = [("c", 0, "raw", 0, "Visa", 90.0), ("c", 0, "raw", 1, "x", 10.0), ("c", 0, "otsu", 0, " ", 90.0)]
    table = spark.createDataFrame([(*d, 0, 0, 0, 0.0, 0.0, 1.0, 1.0) for d in data], words.SCHEMA)
    gone = words.NoWords("strips")
    with pytest.warns(UserWarning, match="strips"):
        got = words.pooled(spark, [(words.TableWords(table), "raw", 1.0), (words.TableWords(table), "raw", 0.85), (gone, "raw", 1.0)]).collect()
    assert sorted(round(r.conf, 3) for r in got) == [0.765, 0.9]
    assert len(words.dictionary()) == len(set(words.dictionary())) and "Titan" in words.dictionary()


def test_switches():
    assert EngineConfig().menu_fusion and not EngineConfig().active("discharge_fee")
    assert EngineConfig.from_options({"discharge": "on"}).active("discharge_fee")
    with pytest.raises(ValueError, match="no such"):
        EngineConfig.from_options({"speed": "1"})


def test_packets_are_decided_as_they_arrive(spark, tmp_path):
    ship(spark)
    (tmp_path / "in").mkdir()
    candidate = {"case_id": "MIB-000001", "cand_ord": 1, "page_index": 0, "fld": "home_world", "value": "Eris Relay", "tier_x10": 20, "source": "digital", "conf_bp": 99}
    packet = {"case_id": "MIB-000001", "candidates": [candidate], "fee_rows": [], "flags": [], "findings": []}
    (tmp_path / "in" / "a.json").write_text(json.dumps(packet) + "\n")
    for _ in range(2):
        query = stream.watch(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), once=True)
        query.awaitTermination(120)
        assert query.exception() is None
    got = rows.read_rows(spark, str(tmp_path / "out/*")).collect()
    assert [(r.case_id, r.home_world, r.adjudication) for r in got] == [("MIB-000001", "Eris Relay", got[0].adjudication)]


def test_long_keys_stay_whole(spark):
    import duckdb

    from evidentia import carriers

    keys = [0, 8, 999_999, 1_000_000, 1_234_560, 1_234_568, 12_345_678_901]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in frame.selectExpr(f"{carriers.case_of('k')} AS c").collect()]
    want = [f"MIB-{k - k % 8:06d}" for k in keys]
    assert got == want
    assert [r[0] for r in duckdb.sql(f"SELECT {carriers.case_of('k')} FROM (SELECT unnest({keys}::BIGINT[]) AS k)").fetchall()] == want
