"""The same results in plain SQL, built from named common table expressions."""

from __future__ import annotations

from evidentia import carriers, dims


def _case(column: str, values: dict, otherwise) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {otherwise} END"


_BONUS = "CASE " + " ".join(f"WHEN fld = '{f}' THEN {_case('tier_x10', t, dims.OTHER_BONUS)}" for f, t in dims.FIELD_BONUS.items()) + f" ELSE {_case('tier_x10', dims.TIER_BONUS, dims.OTHER_BONUS)} END"
_FEE_BONUS = _case("tier_x10", dims.TIER_BONUS, dims.OTHER_BONUS)
_q = dims.quoted

_STEPS: dict[str, str] = {
    "cand": carriers.plain(carriers.CANDIDATES),
    "fee": carriers.plain(carriers.FEE_ROWS),
    "flagc": carriers.plain(carriers.FLAG_CANDIDATES),
    "find": carriers.plain(carriers.FINDINGS),
    "cases": carriers.plain(carriers.CASES),
    "pool": f"SELECT *, (conf_bp * (100 + {_BONUS}))::BIGINT AS weight FROM cand WHERE value IS NOT NULL",
    "voted": """SELECT case_id, fld, value, score, conf_bp, source FROM (
        SELECT s.*, row_number() OVER (PARTITION BY case_id, fld ORDER BY score DESC, first_ord) AS rn FROM (
          SELECT case_id, fld, value, sum(weight)::BIGINT AS score, min(cand_ord) AS first_ord,
                 first(conf_bp ORDER BY conf_bp DESC, cand_ord) AS conf_bp, first(source ORDER BY conf_bp DESC, cand_ord) AS source
          FROM pool GROUP BY case_id, fld, value) s) WHERE rn = 1""",
    "corr": f"""SELECT case_id, fld, value, conf_bp, source FROM (
        SELECT *, row_number() OVER (PARTITION BY case_id, fld ORDER BY weight DESC, cand_ord) AS rn FROM pool WHERE tier_x10 = {dims.CORRECTION_TIER}) WHERE rn = 1""",
    "contested": f"""SELECT * EXCLUDE (hd, hf) FROM (SELECT *, max((source = 'digital')::INT) OVER (PARTITION BY case_id, fld) AS hd,
          max((value LIKE '% %')::INT) OVER (PARTITION BY case_id, fld) AS hf FROM pool)
        WHERE NOT (fld IN ({_q(dims.DIGITAL_FIRST)}) AND hd = 1 AND source <> 'digital') AND NOT (fld = 'applicant_name' AND hf = 1 AND value NOT LIKE '% %')""",
    "cvoted": """SELECT case_id, fld, value, score, conf_bp, source FROM (
        SELECT s.*, row_number() OVER (PARTITION BY case_id, fld ORDER BY score DESC, first_ord) AS rn FROM (
          SELECT case_id, fld, value, sum(weight)::BIGINT AS score, min(cand_ord) AS first_ord,
                 first(conf_bp ORDER BY conf_bp DESC, cand_ord) AS conf_bp, first(source ORDER BY conf_bp DESC, cand_ord) AS source
          FROM contested GROUP BY case_id, fld, value) s) WHERE rn = 1""",
    "dig": """SELECT case_id, min(value) AS dv, max(conf_bp) AS dconf, count(*) AS n FROM (
          SELECT *, tier_x10 IN (20, 30, 50) AS lab, max((tier_x10 IN (20, 30, 50))::INT) OVER (PARTITION BY case_id) AS anylab
          FROM contested WHERE fld = 'applicant_name' AND source = 'digital')
        WHERE lab OR anylab = 0 GROUP BY case_id HAVING min(value) = max(value) AND count(*) >= 2""",
    "digconf": "SELECT case_id, value, max(conf_bp) AS dconf, first(source ORDER BY conf_bp DESC, cand_ord) AS dsource FROM contested WHERE fld = 'applicant_name' GROUP BY 1, 2",
    "named": f"""SELECT v.case_id, v.fld, CASE WHEN d.dv IS NOT NULL AND v.fld = 'applicant_name' AND d.dv <> v.value THEN d.dv ELSE v.value END AS value,
          CASE WHEN d.dv IS NOT NULL AND v.fld = 'applicant_name' AND d.dv <> v.value THEN c.dconf ELSE v.conf_bp END AS conf_bp,
          CASE WHEN d.dv IS NOT NULL AND v.fld = 'applicant_name' AND d.dv <> v.value THEN c.dsource = 'digital' OR c.dconf >= {dims.KNOWN_LEAST} ELSE v.source = 'digital' OR v.conf_bp >= {dims.KNOWN_LEAST} END AS known
        FROM cvoted v LEFT JOIN dig d ON d.case_id = v.case_id LEFT JOIN digconf c ON c.case_id = v.case_id AND c.value = d.dv""",
    "st": "SELECT case_id, page_index, first(status ORDER BY conf_bp DESC, cand_ord) AS status, first(conf_bp ORDER BY conf_bp DESC, cand_ord) AS conf_bp, first(tier_x10 ORDER BY conf_bp DESC, cand_ord) AS tier_x10 FROM fee WHERE status IS NOT NULL GROUP BY 1, 2",
    "am": "SELECT case_id, page_index, first(amount_raw ORDER BY conf_bp DESC, cand_ord) AS amount_raw, first(conf_bp ORDER BY conf_bp DESC, cand_ord) AS conf_bp, first(tier_x10 ORDER BY conf_bp DESC, cand_ord) AS tier_x10 FROM fee WHERE amount_raw IS NOT NULL GROUP BY 1, 2",
    "wa": "SELECT case_id, page_index, first(waiver ORDER BY conf_bp DESC, cand_ord) AS waiver FROM fee WHERE waiver IS NOT NULL GROUP BY 1, 2",
    "pg": "SELECT case_id, page_index, min(cand_ord) AS first_ord FROM fee GROUP BY 1, 2",
    "pv": """SELECT p.case_id, p.page_index, first_ord, coalesce(st.conf_bp, am.conf_bp, 50) AS conf_bp, coalesce(st.tier_x10, am.tier_x10) AS tier_x10,
          st.conf_bp IS NULL AND am.conf_bp IS NULL AS bare,
          CASE amount_raw WHEN '$809.00' THEN 809 WHEN '$0.00' THEN 0 WHEN '$5oO.00' THEN 500 END AS amount, status, waiver
        FROM pg p LEFT JOIN st USING (case_id, page_index) LEFT JOIN am USING (case_id, page_index) LEFT JOIN wa USING (case_id, page_index)""",
    "feep": f"""SELECT * FROM (SELECT case_id, page_index, first_ord, conf_bp, (CASE WHEN bare THEN 5000 ELSE conf_bp * (100 + {_FEE_BONUS}) END)::BIGINT AS weight,
          CASE WHEN amount = 809 THEN 'paid' WHEN amount = 0 AND waiver = 'DIP-WAIVER' THEN 'waived' WHEN amount = 0 AND status = 'unpaid' THEN 'unpaid'
               WHEN amount = 0 THEN 'unknown' WHEN status = 'waived' AND waiver = 'N/A' THEN 'unknown' ELSE status END AS verdict FROM pv) WHERE verdict IS NOT NULL""",
    "fees": """SELECT case_id, verdict AS value, score, conf_bp FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, o) AS rn FROM (
          SELECT case_id, verdict, sum(weight)::BIGINT AS score, min(first_ord) AS o, max(conf_bp) AS conf_bp FROM feep GROUP BY 1, 2)) WHERE rn = 1""",
    "flagu": f"""SELECT case_id, list_sort(list_distinct(flatten(list(list_filter(string_split(flags_text, ','), lambda x: x <> ''))))) AS flags,
          bool_or(flags_text <> '' OR source = 'digital' OR conf_bp >= {dims.NONE_LEAST}) AS flags_known
        FROM flagc WHERE parsed_ok AND conf_bp >= {dims.FLAG_LEAST} GROUP BY case_id""",
    "fown": "SELECT case_id, count(DISTINCT label) AS k, first(label ORDER BY conf_bp DESC, find_ord) AS label, max(conf_bp) AS conf_bp FROM find WHERE NOT template_only GROUP BY case_id",
    "ftem": "SELECT case_id, count(DISTINCT label) AS k, first(label ORDER BY conf_bp DESC, find_ord) AS label, first(template ORDER BY conf_bp DESC, find_ord) AS template, max(conf_bp) AS conf_bp FROM find WHERE template_only GROUP BY case_id",
    "findu": """SELECT case_id, CASE WHEN o.k = 1 THEN o.label END AS finding_label, CASE WHEN o.k = 1 THEN o.conf_bp END AS finding_conf_bp, coalesce(o.k > 1, FALSE) AS finding_conflict,
          CASE WHEN t.k = 1 THEN t.label END AS template_label, CASE WHEN t.k = 1 THEN t.template END AS template, CASE WHEN t.k = 1 THEN t.conf_bp END AS template_conf_bp
        FROM fown o FULL JOIN ftem t USING (case_id)""",
    "ruled": """SELECT case_id, fld, value, conf_bp, known FROM (SELECT *, row_number() OVER (PARTITION BY case_id, fld ORDER BY rank DESC) AS rn FROM (
          SELECT case_id, fld, value, conf_bp, TRUE AS known, 1 AS rank FROM corr UNION ALL SELECT case_id, fld, value, conf_bp, known, 0 FROM named
          UNION ALL SELECT case_id, 'fee_status', value, conf_bp, TRUE, 0 FROM fees)) WHERE rn = 1""",
    "wide": "SELECT c.case_id, " + ", ".join(f"max(value) FILTER (fld = '{f}') AS {f}_value, coalesce(bool_or(known) FILTER (fld = '{f}'), FALSE) AS {f}_known, coalesce(max(conf_bp) FILTER (fld = '{f}'), 0) AS {f}_conf_bp" for f in dims.FIELDS) + " FROM cases c LEFT JOIN ruled USING (case_id) GROUP BY c.case_id",
    "arr": f"SELECT DISTINCT case_id FROM pool WHERE fld = 'arrival_date' AND tier_x10 IN ({dims.CORRECTION_TIER}, {dims.INTAKE_TIER})",
    "ev": """SELECT w.*, coalesce(u.flags, []) AS flags, coalesce(u.flags_known, FALSE) AS flags_known, finding_label, finding_conf_bp, coalesce(finding_conflict, FALSE) AS finding_conflict,
          template_label, template, template_conf_bp, a.case_id IS NOT NULL AS arrival_on_intake
        FROM wide w LEFT JOIN flagu u USING (case_id) LEFT JOIN findu f USING (case_id) LEFT JOIN arr a USING (case_id)""",
    "ek": f"""SELECT *, CASE WHEN visa_class_known THEN visa_class_value END AS visa, CASE WHEN home_world_known THEN home_world_value END AS world,
          CASE WHEN fee_status_known THEN fee_status_value END AS fee, CASE WHEN sponsor_id_known THEN sponsor_id_value END AS sponsor,
          CASE WHEN arrival_on_intake THEN try_cast(arrival_date_value AS DATE) END AS arrival,
          coalesce(CASE WHEN arrival_on_intake THEN DATE '{dims.RECEIPT_DAY}' - try_cast(arrival_date_value AS DATE) END > {dims.STALE_DAYS}, FALSE) AS stale FROM ev""",
    "core": f"""SELECT *, CASE WHEN finding_conflict THEN 'N0_note_conflict' WHEN finding_conf_bp >= {dims.FINDING_LEAST} THEN 'N0_note_' || lower(finding_label)
          WHEN list_has_any(flags, [{_q(dims.DISQUALIFYING_FLAGS)}]) THEN 'R1_disqualifying_flag' WHEN world IN ({_q(dims.HARD_EMBARGO)}) THEN 'R2_hard_embargo_world'
          WHEN fee = 'unpaid' THEN 'R3_fee_unpaid' WHEN visa <> 'DIP-1' AND sponsor IN ({_q(dims.REVOKED_SPONSORS)}) THEN 'R4_revoked_sponsor'
          WHEN visa <> 'DIP-1' AND world IN ({_q(dims.SOFT_EMBARGO)}) THEN 'R5_soft_embargo_world' WHEN visa <> 'DIP-1' AND stale THEN 'R6_stale_arrival'
          WHEN visa = 'TRANSIT-7' THEN 'R7_transit_visa' WHEN fee = 'unknown' THEN 'R8_fee_unknown' WHEN fee IS NULL THEN 'R8_fee_unread'
          WHEN arrival IS NULL THEN 'R9_arrival_not_visible' WHEN list_has_any(flags, [{_q(dims.REVIEW_FLAGS)}]) THEN 'R10_review_flags'
          WHEN NOT flags_known THEN 'R12_flags_unread' WHEN visa IS NULL THEN 'R12_visa_unread' WHEN world IS NULL THEN 'R12_world_unread'
          WHEN visa <> 'DIP-1' AND sponsor IS NULL THEN 'R12_sponsor_unread' ELSE 'R11_default_approve' END AS path0 FROM ek""",
    "deny": f"""SELECT *, (len(flags) > 0 OR coalesce(fee IN ('unpaid', 'unknown'), FALSE) OR coalesce(world IN ({_q(dims.HARD_EMBARGO)}), FALSE) OR coalesce(visa = 'TRANSIT-7', FALSE)
          OR (coalesce(visa, '') <> 'DIP-1' AND (coalesce(sponsor IN ({_q(dims.REVOKED_SPONSORS)}), FALSE) OR coalesce(world IN ({_q(dims.SOFT_EMBARGO)}), FALSE) OR stale))) AS denies,
          path0 IN ({_q(dims.UNDERDETERMINED)}) AS under FROM core""",
    "resc": f"""SELECT *, CASE WHEN under AND template_conf_bp >= {dims.FINDING_LEAST} AND NOT coalesce(CASE WHEN template_label = 'APPROVED' THEN denies
          WHEN template_label = 'DENIED' AND template = 'Mandatory fee unpaid.' THEN fee IN ('paid', 'waived')
          WHEN template_label = 'DENIED' AND template LIKE 'Transit class%' THEN visa <> 'TRANSIT-7' END, FALSE) THEN 'N1_reason_' || lower(template_label) ELSE path0 END AS path FROM deny""",
    "labelled": """SELECT *, CASE WHEN path0 = 'N0_note_conflict' THEN 'NEEDS_REVIEW' WHEN path0 LIKE 'N0%' THEN finding_label WHEN path0 SIMILAR TO 'R[1-7]_.*' THEN 'DENIED' WHEN path0 = 'R11_default_approve' THEN 'APPROVED' ELSE 'NEEDS_REVIEW' END AS label0,
          CASE WHEN path LIKE 'N1%' THEN template_label END AS label1 FROM resc""",
    "lab": "SELECT *, coalesce(label1, label0) AS policy_label FROM labelled",
    "stats": "SELECT * FROM (VALUES " + ", ".join(f"('{p}', {a}, {x}, {y}, {z}, {str(pin).upper()})" for p, (a, x, y, z, pin) in dims.PATHS.items()) + ") v(path, acc, sa, sd, sr, pin)",
    "post": """SELECT l.*, coalesce(acc, 0.5)::DOUBLE AS a, coalesce(pin, TRUE) AS pinned,
          (CASE WHEN policy_label = 'APPROVED' THEN 0 ELSE coalesce(sa, 0.4) END)::DOUBLE AS xa, (CASE WHEN policy_label = 'DENIED' THEN 0 ELSE coalesce(sd, 0.6) END)::DOUBLE AS xd,
          (CASE WHEN policy_label = 'NEEDS_REVIEW' THEN 0 ELSE coalesce(sr, 0) END)::DOUBLE AS xr FROM lab l LEFT JOIN stats USING (path)""",
    "prob": """SELECT *, (CASE WHEN policy_label = 'APPROVED' THEN a ELSE 0 END) + CASE WHEN xa + xd + xr > 0 THEN (1 - a) * (xa / (xa + xd + xr)) ELSE 0 END AS pa,
          (CASE WHEN policy_label = 'DENIED' THEN a ELSE 0 END) + CASE WHEN xa + xd + xr > 0 THEN (1 - a) * (xd / (xa + xd + xr)) ELSE 0 END AS pd,
          (CASE WHEN policy_label = 'NEEDS_REVIEW' THEN a ELSE 0 END) + CASE WHEN xa + xd + xr > 0 THEN (1 - a) * (xr / (xa + xd + xr)) ELSE 0 END AS pn FROM post""",
    "chosen": """SELECT *, CASE WHEN pinned THEN 'NEEDS_REVIEW' WHEN 8 * pa - 4 * pd + pn >= 8 * pd + pn AND 8 * pa - 4 * pd + pn >= 2 * (pa + pd) + 8 * pn THEN 'APPROVED'
          WHEN 8 * pd + pn >= 2 * (pa + pd) + 8 * pn THEN 'DENIED' ELSE 'NEEDS_REVIEW' END AS adjudication FROM prob""",
    "dec": f"""SELECT *, least(greatest(CASE adjudication WHEN 'APPROVED' THEN pa WHEN 'DENIED' THEN pd ELSE pn END, {dims.CONF_FLOOR}), {dims.CONF_CEIL})::DOUBLE AS confidence FROM chosen""",
    "raw": "SELECT case_id, adjudication, round(confidence, 4)::DOUBLE AS confidence, CASE WHEN len(flags) > 0 THEN array_to_string(flags, '|') ELSE 'none' END AS risk_flags, " + ", ".join(f"coalesce(nullif({f}_value, ''), '{dims.DEFAULTS[f]}') AS {f}" for f in dims.FIELDS) + " FROM dec",
    "em1": f"""SELECT * REPLACE (CASE WHEN adjudication = 'APPROVED' THEN 'none' ELSE risk_flags END AS risk_flags,
          CASE WHEN adjudication = 'APPROVED' AND home_world IN ({_q(dims.HARD_EMBARGO)}) THEN 'Luyten-b' ELSE home_world END AS home_world,
          CASE WHEN adjudication = 'APPROVED' AND fee_status IN ('unpaid', 'unknown') THEN 'paid' ELSE fee_status END AS fee_status,
          CASE WHEN adjudication = 'APPROVED' AND visa_class = 'TRANSIT-7' THEN 'MED-3' ELSE visa_class END AS visa_class) FROM raw""",
    "row": f"""SELECT * REPLACE (CASE WHEN adjudication = 'APPROVED' AND visa_class <> 'DIP-1' AND sponsor_id IN ({_q(dims.REVOKED_SPONSORS)}) THEN 'SPN-0000' ELSE sponsor_id END AS sponsor_id,
          CASE WHEN adjudication = 'APPROVED' AND visa_class <> 'DIP-1' AND home_world IN ({_q(dims.SOFT_EMBARGO)}) THEN 'Luyten-b' ELSE home_world END AS home_world,
          CASE WHEN adjudication = 'APPROVED' AND visa_class <> 'DIP-1' AND DATE '{dims.RECEIPT_DAY}' - arrival_date::DATE > {dims.STALE_DAYS} THEN '2026-04-14' ELSE arrival_date END AS arrival_date) FROM em1""",
    "gold": """SELECT case_id, CASE hash_ix % 5 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'DENIED' ELSE label0 END AS truth, hash_ix FROM (SELECT case_id, label0, cast(substr(case_id, 5) AS BIGINT) / 8 AS hash_ix FROM lab)""",
}


def sql(final: str, **more: str) -> str:
    """final over the steps it needs, in their order."""
    import re

    steps = _STEPS | more
    names = list(steps)
    need: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in names:
            if name not in need and re.search(rf"(?:\bFROM|\bJOIN|,)\s+{name}\b", text):
                need.add(name)
                todo.append(steps[name])
    return "WITH " + ",\n".join(f"{n} AS ({steps[n]})" for n in names if n in need) + "\n" + final
