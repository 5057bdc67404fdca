"""Second looks and the laboratory against plain evaluation."""

import numpy as np
import pytest

from evidentia import carriers, dims
from evidentia.catalogue import decided
from evidentia.config import EngineConfig
from evidentia.operators import laboratory as L
from evidentia.operators import policy as P
from evidentia.operators import rereads as R


def test_spans_of_traces(spark):
    rows = [([104, 233, 128512], "Foo-Oblique", [0.1]), ([], None, [])]
    got = R.spans_of(spark.createDataFrame(rows, "chars array<int>, font string, color array<double>")).collect()
    assert [(r.text, r.italic, r.color) for r in got] == [("hé😀", True, [0.1]), ("", False, None)]


def test_views_follow_the_switches(spark):
    pages = spark.createDataFrame([(1, True, 0, None, None), (2, False, 3, None, None), (3, False, 0, 2, True), (4, True, 0, 3, False)], "p int, upright boolean, best_rot int, probe_k int, probe_confident boolean")

    def turns(**on):
        rows = R.escalation_views(pages, EngineConfig(**on)).collect()
        return {p: [(r.k, r.padded) for r in sorted(rows, key=lambda r: r.view_ord) if r.p == p] for p in (1, 2, 3, 4)}

    assert turns() == {p: [(0, False)] for p in (1, 2, 3, 4)}
    assert turns(escalation_views=True) == {1: [(0, False)], 2: [(1, True), (3, True)], 3: [(1, True), (3, True)], 4: [(0, False)]}
    assert turns(rotation_probe=True) == {1: [(0, False)], 2: [(0, False)], 3: [(2, True)], 4: [(3, True), (1, True)]}


def test_greedy_decoding_equals_a_loop(spark):
    rng = np.random.default_rng(4)
    data = [(n, rng.normal(size=(t, 4)).tolist()) for n, t in enumerate([1, 5, 20, 20, 20])] + [(9, []), (10, [[5.0, 0.0, 0.0, 0.0]])]
    got = {r.n: (r.r.text, r.r.conf) for r in spark.createDataFrame(data, "n int, f array<array<double>>").select("n", R.greedy_decode(R.F.col("f"), "ab").alias("r")).collect()}
    for n, frames in data:
        text, sure, before = "", [], None
        for f in frames:
            p = np.exp(f) / np.exp(f).sum()
            best = int(p.argmax())
            if best and best != before:
                text += "ab"[best - 1] if best <= 2 else ""
                sure.append(p[best])
            before = best
        assert got[n] == (text, pytest.approx(np.mean(sure) if sure else 0.0))


def test_reader_lines(spark):
    boxes = [
        ("c", 0, 0, 90, 0, 130, 14, "right", 0.8), ("c", 0, 1, 5, 2, 60, 16, " left ", 0.6), ("c", 0, 2, 6, 2, 60, 16, "again", 0.9),
        ("c", 0, 3, 300, 0, 340, 14, " ", 0.9), ("c", 0, 4, 301, 0, 340, 14, "shadowed", 0.9), ("c", 0, 5, 5, 40, 60, 54, "SPN: 1234", 0.9), ("c", 0, 6, 5, 80, 60, 94, "below", 0.5),
    ]
    got = R.reader_lines(spark.createDataFrame(boxes, "case_id string, page_index int, box_ord int, x0 int, y0 int, x1 int, y1 int, text string, conf double"))
    assert [(r.text, pytest.approx(r.conf), r.tier1_ok) for r in got.orderBy("line_ord").collect()] == [("left right", 0.7 * 0.85, False), ("below", 0.5 * 0.85, False)]


def test_heads_abstain_unless_views_agree(spark):
    schema = "case_id string, page_index int, view string, value string, raw string, conf_bp int"
    revoked = dims.REVOKED_SPONSORS[0]
    reads = [("one", 0, "raw-0", "SPN-9999", "x", 50), ("one", 0, "raw-1", "SPN-9999", "x", 40), ("two", 0, "raw-0", "SPN-9999", "x", 50), ("two", 0, "otsu-0", "SPN-9999", "y", 40),
             ("odd", 0, "raw-0", "SPN-9999", "x", 50), ("odd", 0, "otsu-0", "SPN-9998", "x", 40), ("bad", 0, "raw-0", revoked, revoked, 50), ("bad", 0, "otsu-0", revoked, "garbled", 40),
             ("far", 0, "raw-0", "SPN-9999", "x", 50), ("far", 0, "otsu-0", "SPN-9999", "x", 50), ("far", 1, "raw-0", "SPN-1111", "x", 50), ("far", 1, "otsu-0", "SPN-1111", "x", 50)]
    assert [(r.case_id, r.value, r.conf_bp) for r in R.sole_gap(spark.createDataFrame(reads, schema), "sponsor_id").collect()] == [("two", "SPN-9999", 40)]
    assert R.sole_gap(spark.createDataFrame([], schema), "sponsor_id").count() == 0


def test_discharged_packets_are_decided_again(spark):
    folder = "/root/testdata/sf0.001"
    first = decided(spark, folder).cache()
    every = carriers.read(spark, folder, carriers.CASES)
    fills = every.select("case_id", R.F.lit("fee_status").alias("fld"), R.F.lit("paid").alias("value"), R.F.lit(80).alias("conf_bp"))
    stats = dims.path_stats(spark)
    assert R.discharged(first, fills, stats, EngineConfig()) is first
    got = {r.case_id: r for r in R.discharged(first, fills, stats, EngineConfig(discharge=True)).collect()}
    filled = first.withColumns({"fee_status_value": R.F.lit("paid"), "fee_status_known": R.F.lit(True)}).drop("policy_label", "path", "adjudication", "confidence")
    again = {r.case_id: r for r in P.decide(P.cascade(filled), stats).collect()}
    before = {r.case_id: r for r in first.collect()}
    hit = {c for c, r in before.items() if r.path == "R8_fee_unread"}
    assert hit and set(got) == set(before)
    for c, r in got.items():
        want = again[c] if c in hit else before[c]
        assert (r.path, r.adjudication) == (want.path, want.adjudication)
        assert r.confidence == (min(want.confidence, 0.9) if c in hit else want.confidence)


def test_tally_percentile_is_the_sorted_entry(spark):
    rng = np.random.default_rng(2)
    score = rng.integers(0, 60, 130) / 10
    rows = [("x", "x", float(s), float(i)) for i, s in enumerate(score)] + [("x", None, 9.0, 0.0), (None, None, 9.0, 0.0), (None, "x", 0.0, 0.0), ("x", "y", 0.0, 0.0)]
    r = L.tally(spark.createDataFrame(rows, "expected string, value string, score double, margin double")).first()
    assert (r.ok, r.wrong, r.abstain_genuine, r.abstain_probe) == (130, 2, 1, 1)
    assert (r.score_min, r.score_p5, r.margin_p5) == (score.min(), sorted(score)[6], 6.0)
    nothing = L.tally(spark.createDataFrame([], "expected string, value string, score double, margin double")).collect()
    assert [(r.ok, r.score_p5) for r in nothing] == [(0, None)]


def test_weld_scores_equal_shifting_by_hand():
    rng = np.random.default_rng(6)
    band = np.tile((rng.random(90) < 0.2) * 255.0, (20, 1))
    band[:10] = 0
    band[:10, 16:] = band[10, :-16]
    want = []
    for cut in range(6, 15, 2):
        top, bottom = band[cut - 3 : cut].sum(axis=0), band[cut : cut + 3].sum(axis=0)
        for d in [s * x for x in range(12, 90, 2) for s in (1, -1)]:
            moved = np.array([top[i + d] if 0 <= i + d < 90 else 0 for i in range(90)])
            if np.minimum(moved, bottom).sum() > (np.minimum(top, bottom).sum() + 1e-6) * 1.15:
                want.append((np.minimum(moved, bottom).sum(), cut, d))
    assert sorted(L.weld_scores(band)) == sorted(want) and want
    assert L.weld_scores(np.zeros((20, 90))) == [] and L.weld_scores(band[:5]) == []


def test_weld_bands():
    ink = np.zeros((200, 30))
    ink[20:40] = ink[46:70] = ink[120:125] = ink[180:200] = 1
    assert L.weld_bands(ink) == [(16, 74), (176, 200)] and L.weld_bands(np.zeros((5, 5))) == []


def test_annotations_leave_the_rest_open(spark):
    found = spark.createDataFrame([("a", 0, 0, {"x": "1"}), ("a", 0, 1, {"x": "1"}), ("b", 0, 0, {"x": "1"}), ("c", 0, 0, {"x": None, "y": "2"})], "case_id string, page_index int, rotation int, values map<string, string>")
    notes = spark.createDataFrame([("a", 0, 0, {"x": "1"}), ("c", 0, None, {"x": "1", "z": "3"})], "case_id string, page_index int, rotation int, expected map<string, string>")
    got = {(r.case_id, r.rotation): (r.label_match, r.label_conflicts) for r in L.annotated(found, notes).collect()}
    assert got == {("a", 0): (True, []), ("a", 1): (None, []), ("b", 0): (None, []), ("c", 0): (False, ["x"])}
