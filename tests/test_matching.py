"""Distances, matches and repairs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.functions import fuzzy
from evidentia.functions import match as M
from evidentia.functions import text as T
from evidentia.plans.ship import ship


@pytest.mark.parametrize(("a", "b", "d"), [("", "", 0), ("abc", "ABC", 0), ("0", "O", 0.2), ("a.b", "ab", 0.35), ("ab", "a.b", 0.35), ("abc", "abd", 1), ("SPN", "5PN", 0.2), ("", "a.", 2)])
def test_weighted_distance(a, b, d):
    assert fuzzy.distance(a, b) == pytest.approx(d)


def test_fused_letters_cost_less_and_never_more():
    assert fuzzy.distance("cliplornatic", "diplomatic", True) == pytest.approx(0.8)
    rng = random.Random(8090)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcdilmnrvw .-|09", k=rng.randint(0, 9))) for _ in range(2))
        assert fuzzy.distance(a, b, True) <= fuzzy.distance(a, b) + 1e-9
        assert fuzzy.distance(a, a) == 0


def indel(c):
    return 0.35 if c in dims.CHEAP_INDEL else 1.0


def substitution(x, y, fused):
    if x.lower() == y.lower():
        return 0.0
    near = any(x.lower() in g and y.lower() in g for g in dims.CONFUSIONS)
    alike = fused and any({x.lower(), y.lower()} == set(p) for p in dims.FUSION_SINGLES)
    return 0.2 if near else 0.4 if alike else 1.0


def plain_distance(a, b, fused=False):
    """By exhaustive recursion over edits."""
    if not a:
        return sum(indel(c) if fused else 1.0 for c in b)
    ways = [plain_distance(a[:-1], b, fused) + indel(a[-1])]
    if b:
        ways += [plain_distance(a, b[:-1], fused) + indel(b[-1]), plain_distance(a[:-1], b[:-1], fused) + substitution(a[-1], b[-1], fused)]
    for s, t in [p for x, y in dims.FUSIONS for p in ((x, y), (y, x))] if fused else ():
        if a.lower().endswith(s) and b.lower().endswith(t):
            ways.append(plain_distance(a[: -len(s)], b[: -len(t)], fused) + 0.4)
    return min(ways)


def test_distance_equals_exhaustive_search():
    words = ["", "a", "O0", "rn.", "1l|", "S-5", "clm", "mrn", "VVnn", "É漢w", "8G", "B6"]
    for fused in (False, True):
        a, b = zip(*itertools.product(words, repeat=2), strict=True)
        want = [plain_distance(x, y, fused) if x != y else 0 for x, y in zip(a, b, strict=True)]
        assert fuzzy.distances(list(a), list(b), fused).tolist() == pytest.approx(want)


def test_vocabulary_needs_nearness_and_a_margin():
    assert M.nearest(["Barnard-c"], dims.WORLDS, 0.3)[0] == "Barnard-c"
    assert M.nearest(["Eris Re1ay"], dims.WORLDS, 0.3)[0] == "Eris Relay"
    assert M.nearest(["XW-"], dims.VISAS, 0.3)[0] is None  # XW-1 and XW-2 are as near
    assert M.nearest(["  "], dims.VISAS, 0.3)[0] is None
    assert M.nearest(["cliplornatic"], dims.PURPOSES, 0.05)[0] is None


def anchor(text):
    (row,) = M.labels([text]).itertuples(index=False)
    return tuple(row) if row.label else None


def test_batches_equal_single_texts():
    texts = ["Sponsor ID: SPN-1234", "", "| F1ND1NG: DEN1ED.", "Mandatory fee unpa1d.", "| FINDING: NEEDS 7. | |", "Aririx Ixozrn", "rescin", "none.", "FINDING: APPROVED", "Visa Class", "é 漢", "memory_tampering/active_warrant"]
    for f in (M.names, M.joint_names, M.phrases, M.reasons, M.flag_reads, M.cut_flags, lambda x: M.flag_reads(x, True), lambda x: M.nearest(x, dims.LABELS, 0.3), lambda x: [tuple(r) for r in M.labels(x).itertuples(index=False)]):
        assert f(texts) == [f([t])[0] for t in texts] and f([]) == []
    pages = [texts, [], ["| MIB Fee Receipt"], ["nothing to see here"], ["Planetary Reg1stry Extract MIB-000001"]]
    assert M.headers(pages).values.tolist() == [[None, 50], [None, 50], ["fee_receipt", 25], [None, 50], ["registry", 50]]


def test_repeated_lines_are_compared_with_headers_once(monkeypatch):
    pairs, far = [], M.fuzzy.distances
    monkeypatch.setattr(M.fuzzy, "distances", lambda a, b: pairs.append(len(a)) or far(a, b))
    page = ["some words", "MIB Fee Receipt", "Amount: $809.00"]
    assert M.headers([page] * 50).values.tolist() == M.headers([page]).values.tolist() * 50
    assert pairs[0] == pairs[1]


def test_anchors_take_the_first_near_label_then_try_without_spaces():
    assert anchor("Sponsor ID: SPN-1234") == ("sponsor_id", "Sponsor ID", "SPN-1234")
    assert anchor("| | H0me Wor1d Titan Freeport") == ("home_world", "Home World", "Titan Freeport")
    assert anchor("SponsorID:SPN-8468") == ("sponsor_id", "Sponsor ID", "SPN-8468")
    assert anchor("completely different words here") is None and anchor("") is None and anchor("|") is None


def test_flags():
    assert M.flag_reads(["none."])[0] == ([], True) and M.flag_reads(["n0ne"])[0] == ([], True) and M.flag_reads([""])[0] == ([], False)
    assert M.flag_reads(["memory_tampering, sponsor mismatch"])[0] == (["memory_tampering", "sponsor_mismatch"], True)
    assert M.flag_reads(["rescin"], True)[0] == (["rescinded_denial"], True) and M.flag_reads(["resc"], True)[0][0] == ["rescinded_denial"]
    assert M.flag_reads(["resc"])[0] == ([], False)


def test_names():
    assert M.names(["Aririx lxozarn PASSPORT IMAGE"])[0] == "Aririx Ixozarn"
    assert M.names(["[NAME CUT OUT]"])[0] is None
    assert M.joint_names(["Aririx Ixozrn"])[0] == "Aririx Ixozarn"
    assert M.joint_names(["Aririx lozan"])[0] is None  # Luzarn is as near
    assert M.joint_names(["one"])[0] is None


def test_phrases_and_truncation():
    assert M.phrases(["| F1ND1NG: DEN1ED."])[0] == "DENIED"
    assert M.phrases(["| FINDING: NEEDS 7. | |"])[0] is None
    assert M.phrases(["DENIED"])[0] is None
    assert M.reasons(["Mandatory fee unpa1d."])[0] == "Mandatory fee unpaid."
    assert M.reasons(["Mandatory fee"])[0] is None


def test_partial_ratio_bound_is_a_bound():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("ABCDE ", k=rng.randint(1, 12))) for _ in range(2))
        assert fuzzy.partial_ratio(a, b) <= fuzzy.ratio_bound(a, b) + 1e-9


def columns(spark, values, column):
    ship(spark)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    return [r.out for r in frame.select("i", column(F.col("raw")).alias("out")).orderBy("i").collect()]


def test_sponsor_ids(spark):
    raws = ["SPN-1234", " SPN_O1Z3 ", "SPN 12345", "N-5809", None, "xSPN-58O9 7"]
    assert columns(spark, raws, T.repair_sponsor_id) == ["SPN-1234", "SPN-0123", None, None, None, "SPN-5809"]
    assert columns(spark, ["N-5809", "5809"], lambda c: T.repair_sponsor_id(c, loose=True)) == ["SPN-5809", None]


def test_dates(spark):
    raws = ["2026-04-14", "2O26.04.l4", "2028/01/02", "2015-11-03", "2023-01-01", "2026-02-30", "", None]
    assert columns(spark, raws, T.repair_date) == ["2026-04-14", "2026-04-14", "2026-01-02", "2025-11-03", None, None, None, None]


def test_captions_footers_and_corrections(spark):
    assert columns(spark, ["AQUARIAN_MANTIS SCAN IMAGE | COPY", " x ", None], T.strip_captions) == ["AQUARIAN_MANTIS", "x", None]
    assert columns(spark, ["a Packet MIB-000123 / page 2 of 3 b MIB-000001 page"], T.strip_footer) == ["a b"]
    got = columns(spark, ["Manual correction: the home world is Titan Freeport.", "manual correction visa MED-3", "Sponsor is x"], T.parse_correction)
    assert got[0].asDict() == {"fld": "home_world", "value": "Titan Freeport"} and got[1] is None and got[2] is None


def test_bound_column_equals_the_function(spark):
    pairs = [("AAB", "ABB"), ("X", "Y"), ("HELLO WORLD", "LOW"), ("", "A")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = {(r.a, r.b): r.d for r in frame.select("a", "b", fuzzy.ratio_bound_column(F.col("a"), F.col("b")).alias("d")).collect()}
    assert all(got[p] == pytest.approx(fuzzy.ratio_bound(*p)) for p in pairs)
