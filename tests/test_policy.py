"""Votes, the cascade's order, decisions, the emission guard and restores, on hand-made evidence."""

import pytest
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.operators import evidence as E
from evidentia.operators import policy as P
from evidentia.plans.ship import ship

VALUES = {"applicant_name": "Aririx Ixozarn", "species_code": "TRIANGULAN", "home_world": "Luyten-b", "visa_class": "MED-3", "sponsor_id": "SPN-1234", "arrival_date": "2026-05-04", "declared_purpose": "research", "fee_status": "paid"}
SCHEMA = "case_id string, " + ", ".join(f"{f}_value string, {f}_known boolean, {f}_conf_bp int" for f in dims.FIELDS) + ", flags array<string>, flags_known boolean, finding_label string, finding_conf_bp int, finding_conflict boolean, template_label string, template string, template_conf_bp int, arrival_on_intake boolean"


def case(name="c", flags=(), flags_known=True, finding=None, conf=90, conflict=False, template=None, intake=True, **changed):
    fields = VALUES | changed
    row = [name]
    for f in dims.FIELDS:
        row += [fields[f], fields[f] is not None, 90]
    label = dims.REASON_LABELS.get(template)
    return (*row, list(flags), flags_known, finding, conf if finding else None, conflict, label, template, 90 if template else None, intake)


CASES = [
    (case(), "R11_default_approve"),
    (case(conflict=True, flags=["biohazard_red"]), "N0_note_conflict"),
    (case(finding="DENIED"), "N0_note_denied"),
    (case(finding="DENIED", conf=54), "R11_default_approve"),
    (case(flags=["active_warrant"], home_world="Eris Relay"), "R1_disqualifying_flag"),
    (case(home_world="TRAPPIST-1e", visa_class="DIP-1"), "R2_hard_embargo_world"),
    (case(fee_status="unpaid", sponsor_id="SPN-0007"), "R3_fee_unpaid"),
    (case(visa_class="TRANSIT-7", sponsor_id="SPN-0007"), "R4_revoked_sponsor"),
    (case(visa_class="DIP-1", sponsor_id="SPN-0007"), "R11_default_approve"),
    (case(home_world="Wolf-1061c"), "R5_soft_embargo_world"),
    (case(arrival_date="2026-01-08"), "R11_default_approve"),
    (case(arrival_date="2026-01-07"), "R6_stale_arrival"),
    (case(visa_class="TRANSIT-7"), "R7_transit_visa"),
    (case(fee_status="unknown", flags=["sponsor_mismatch"]), "R8_fee_unknown"),
    (case(fee_status=None), "R8_fee_unread"),
    (case(intake=False), "R9_arrival_not_visible"),
    (case(arrival_date="2026-02-30"), "R9_arrival_not_visible"),
    (case(flags=["identity_conflict"], flags_known=False), "R10_review_flags"),
    (case(flags_known=False), "R12_flags_unread"),
    (case(visa_class=None), "R12_visa_unread"),
    (case(home_world=None), "R12_world_unread"),
    (case(sponsor_id=None), "R12_sponsor_unread"),
    (case(sponsor_id=None, visa_class="DIP-1"), "R11_default_approve"),
]


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(str(i), *r[1:]) for i, r in enumerate(rows)], SCHEMA)


def test_the_first_rule_that_holds_decides(spark):
    got = P.cascade(frame(spark, [c for c, _ in CASES])).collect()
    assert {int(r.case_id): r.path for r in got} == {i: p for i, (_, p) in enumerate(CASES)}
    for r in got:
        assert r.policy_label == ("APPROVED" if r.path == "R11_default_approve" else "NEEDS_REVIEW" if r.path.startswith(("R8", "R9", "R10", "R12", "N0_note_conflict")) else "DENIED")


def test_reasons_alone_settle_only_what_was_not_read_and_not_contradicted(spark):
    t = {v: k for k, v in reversed(dims.REASON_LABELS.items())}
    rows = [
        (case(fee_status=None, template="Mandatory fee unpaid."), "N1_reason_denied"),
        (case(flags_known=False, template="Mandatory fee unpaid."), "R12_flags_unread"),
        (case(template="Mandatory fee unpaid."), "R11_default_approve"),
        (case(visa_class=None, template=t["APPROVED"]), "N1_reason_approved"),
        (case(visa_class=None, sponsor_id="SPN-0007", template=t["APPROVED"]), "R12_visa_unread"),
        (case(flags_known=False, visa_class="DIP-1", sponsor_id="SPN-0007", template=t["APPROVED"]), "N1_reason_approved"),
        (case(fee_status=None, template="Transit class cannot authorize declared work."), "R8_fee_unread"),
    ]
    got = P.template_rescue(P.cascade(frame(spark, [c for c, _ in rows]))).collect()
    assert {int(r.case_id): r.path for r in got} == {i: p for i, (_, p) in enumerate(rows)}


def test_decisions_weigh_points_and_hold_pinned_paths(spark):
    paths = [*dims.PATHS, "never heard of"]
    decided = spark.createDataFrame([(p, "NEEDS_REVIEW" if p not in dims.PATHS else None) for p in paths], "path string, given string")
    decided = decided.withColumn("policy_label", F.coalesce("given", P.policy_label_of(F.col("path")))).drop("given")
    for r in P.decide(decided, dims.path_stats(spark)).collect():
        accuracy, *shares, pinned = dims.PATHS.get(r.path, dims.OTHER_PATH)
        chance = dict.fromkeys(dims.LABELS, 0.0)
        chance[r.policy_label] = accuracy
        rest = {c: s for c, s in zip(dims.LABELS, shares) if s and c != r.policy_label}
        for c, s in rest.items():
            chance[c] += (1 - accuracy) * (s / sum(rest.values()))
        a, d, n = (chance[c] for c in dims.LABELS)
        points = {"APPROVED": 8 * a - 4 * d + n, "DENIED": 8 * d + n, "NEEDS_REVIEW": 2 * (a + d) + 8 * n}
        label = "NEEDS_REVIEW" if pinned else max(dims.LABELS, key=points.__getitem__)
        assert r.adjudication == label and r.confidence == pytest.approx(min(0.97, max(0.05, chance[label])))


ROW = "case_id string, " + ", ".join(f"{f} string" for f in dims.FIELDS) + ", risk_flags string, adjudication string, confidence double"


@pytest.mark.parametrize(("changed", "want"), [
    ({"visa_class": "TRANSIT-7", "sponsor_id": "SPN-0007"}, {"visa_class": "MED-3", "sponsor_id": "SPN-0000"}),
    ({"visa_class": "DIP-1", "sponsor_id": "SPN-0007", "home_world": "Wolf-1061c", "arrival_date": "2025-01-01"}, {}),
    ({"visa_class": "DIP-1", "home_world": "Eris Relay"}, {"home_world": "Luyten-b"}),
    ({"fee_status": "unknown", "arrival_date": "2025-01-01"}, {"fee_status": "paid", "arrival_date": "2026-04-14"}),
    ({"arrival_date": "2026-02-30"}, {"arrival_date": "2026-04-14"}),
])
def test_approved_rows_lose_what_would_deny_them(spark, changed, want):
    fields = VALUES | changed
    rows = spark.createDataFrame([(x, *fields.values(), "sponsor_mismatch", x, 0.9) for x in ("APPROVED", "DENIED")], ROW)
    got = {r.adjudication: r.asDict() for r in P.suppress_deny_triggers(rows).collect()}
    assert {k: got["DENIED"][k] for k in fields} == fields and got["DENIED"]["risk_flags"] == "sponsor_mismatch"
    assert {k: got["APPROVED"][k] for k in fields} == fields | want and got["APPROVED"]["risk_flags"] == "none"


def test_rows_are_whole(spark):
    nothing = case(**dict.fromkeys(VALUES), flags_known=False)
    rows = P.build_row(P.decide(P.cascade(frame(spark, [nothing, case(sponsor_id="bad")])), dims.path_stats(spark))).collect()
    assert rows[0].asDict() | {"case_id": "", "adjudication": "", "confidence": 0} == {"case_id": "", **dims.DEFAULTS, "risk_flags": "none", "adjudication": "", "confidence": 0}
    assert rows[1].sponsor_id == "SPN-0000"


def test_votes_sum_and_ties_go_to_the_first(spark):
    c = [("k", 1, 0, "home_world", "A", 20, "ocr", 50), ("k", 2, 0, "home_world", "B", 20, "ocr", 50), ("k", 3, 1, "home_world", "C", 50, "ocr", 90), ("k", 4, 1, "home_world", "B", 50, "ocr", 30), ("j", 1, 0, "visa_class", "X", 20, "ocr", 60), ("j", 2, 0, "visa_class", "Y", 20, "ocr", 60), ("j", 3, 0, "visa_class", None, 10, "ocr", 99)]
    frame = spark.createDataFrame(c, "case_id string, cand_ord long, page_index int, fld string, value string, tier_x10 int, source string, conf_bp int")
    got = {r.case_id: (r.value, r.score) for r in E.vote(E.weighted(frame)).collect()}
    assert got == {"k": ("C", 90 * 115), "j": ("X", 60 * 130)}


@pytest.mark.parametrize(("status", "amount", "waiver", "want"), [
    ("unpaid", 809, None, "paid"), (None, 0, "DIP-WAIVER", "waived"), ("unpaid", 0, "N/A", "unpaid"), ("paid", 0, None, "unknown"), (None, 0, None, "unknown"),
    ("waived", None, "N/A", "unknown"), ("waived", None, None, "waived"), ("paid", 500, "N/A", "paid"), (None, None, "N/A", None),
])
def test_receipts(spark, status, amount, waiver, want):
    row = spark.createDataFrame([(status, amount, waiver)], "s string, a int, w string")
    assert row.select(E.receipt_verdict(F.col("s"), F.col("a"), F.col("w"))).first()[0] == want


def test_amounts(spark):
    frame = spark.createDataFrame([("$8O9.00",), ("809",), ("$l,200",), ("none",), (None,)], "raw string")
    assert [r[0] for r in frame.select(E.parse_amount(F.col("raw"))).collect()] == [809, 809, 1, None, None]


def test_later_passes_only_fill(spark):
    before = frame(spark, [case(home_world=None)])
    after = frame(spark, [case(home_world="Europa Station", visa_class="DIP-1")])
    (r,) = P.restore_guard(before, after).collect()
    assert (r.home_world_value, r.visa_class_value) == ("Europa Station", "MED-3")


def test_tallies_of_a_run(spark):
    from evidentia.plans.metrics import tallied

    decided = P.decide(P.cascade(frame(spark, [case(), case(fee_status=None), case(fee_status="unpaid")])), dims.path_stats(spark))
    out, seen = tallied(decided)
    assert out.count() == 3
    assert seen.get == {"rows": 3, "underdetermined": 1, "approved": 1, "denied": 1, "needs_review": 1}


@pytest.mark.parametrize(("digital", "want"), [
    ([("Aririx lxozarn", 20)], ("Aririx lxozarn", 40, True)),  # alone, but close to the vote
    ([("Nexkesh Oriul", 20)], ("Aririx Ixozarn", 90, True)),  # alone and far
    ([("Nexkesh Oriul", 20), ("Nexkesh Oriul", 30)], ("Nexkesh Oriul", 40, True)),
    ([("Nexkesh Oriul", 40), ("Nexkesh Oriul", 40), ("Solmora Tekix", 50)], ("Aririx Ixozarn", 90, True)),  # a labelled row before prose
    ([("Nexkesh Oriul", 20), ("Solmora Tekix", 20)], ("Aririx Ixozarn", 90, True)),
    ([], ("Aririx Ixozarn", 90, True)),
])
def test_digital_names_outdo_the_vote_only_when_safe(spark, digital, want):
    ship(spark)
    rows = [("c", i, i, "applicant_name", "Aririx Ixozarn", 20, "ocr", 90) for i in range(3)] + [("c", 10 + i, 5, "applicant_name", v, t, "digital", 40) for i, (v, t) in enumerate(digital)]
    frame = spark.createDataFrame(rows, "case_id string, cand_ord long, page_index int, fld string, value string, tier_x10 int, source string, conf_bp int")
    (r,) = E.settle(E.digital_first(E.weighted(frame))).collect()
    assert (r.value, r.conf_bp, r.known) == want
