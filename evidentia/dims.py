"""Vocabularies, tables and thresholds that results must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPECIES = ("ALPHA_DRACONIAN", "ANDROMEDAN", "AQUARIAN_MANTIS", "ARCTURIAN", "CENTAURI_SYNTH", "JOVIAN_GASFORM", "KAIJU_MICRO", "LUNA_SECURID", "ORION_GRAYS", "SIRIUS_AVIAN", "TRIANGULAN", "VENUSIAN_MYCELIAL")
WORLDS = ("Barnard-c", "Eris Relay", "Europa Station", "Gliese-581g", "Kepler-186f", "Luyten-b", "Mars Dome-7", "Proxima-b", "Sirius Outpost", "Titan Freeport", "TRAPPIST-1e", "Wolf-1061c", "Zeta Reticuli")
VISAS = ("XW-1", "XW-2", "DIP-1", "MED-3", "TRANSIT-7")
PURPOSES = ("archive audit", "cultural exchange", "diplomatic", "field repair", "medical consult", "reactor maintenance", "research", "transit", "translation", "xenobotany")
FEES = ("paid", "waived", "unpaid", "unknown")
FLAGS = ("active_warrant", "biohazard_red", "identity_conflict", "illegible_biometrics", "memory_tampering", "planetary_embargo", "rescinded_denial", "sponsor_mismatch")
REGISTRY_STATUSES = ("CLEAR", "EMBARGO REVIEW")
LABELS = ("APPROVED", "DENIED", "NEEDS_REVIEW")

DISQUALIFYING_FLAGS = ("active_warrant", "biohazard_red", "memory_tampering", "planetary_embargo")
REVIEW_FLAGS = ("identity_conflict", "illegible_biometrics", "rescinded_denial", "sponsor_mismatch")
REVOKED_SPONSORS = ("SPN-0007", "SPN-0139", "SPN-2718", "SPN-4040", "SPN-7331", "SPN-9090")
HARD_EMBARGO = ("Eris Relay", "TRAPPIST-1e")
SOFT_EMBARGO = ("Wolf-1061c",)
RECEIPT_DAY, STALE_DAYS = "2026-07-07", 180
FINDING_LEAST = 55

FIELDS = ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "fee_status")
DIGITAL_FIRST = ("visa_class", "sponsor_id", "arrival_date")
DEFAULTS = {"applicant_name": "", "species_code": "TRIANGULAN", "home_world": "Luyten-b", "visa_class": "MED-3", "sponsor_id": "SPN-0000", "arrival_date": "2026-04-14", "declared_purpose": "reactor maintenance", "fee_status": "paid"}

#: Bonus in percent by ten times the tier; another tier has OTHER_BONUS.
TIER_BONUS = {10: 50, 15: 45, 20: 30, 25: 30, 30: 25, 40: 20, 50: 15}
REGISTRY_FIRST = {10: 50, 15: 45, 50: 35, 40: 30, 30: 25, 20: 20, 25: 20}
ATTESTATION_FIRST = {10: 50, 15: 45, 40: 35, 50: 30, 30: 25, 20: 20, 25: 20}
FIELD_BONUS = {"arrival_date": REGISTRY_FIRST, "applicant_name": REGISTRY_FIRST, "sponsor_id": ATTESTATION_FIRST}
OTHER_BONUS = 10
CORRECTION_TIER, INTAKE_TIER = 15, 20
KNOWN_LEAST, FLAG_LEAST, NONE_LEAST = 55, 40, 50

#: path: accuracy, error shares of APPROVED, DENIED and NEEDS_REVIEW, whether the outcome is held at NEEDS_REVIEW.
PATHS = {
    "N0_note_conflict": (0.5, 0.4, 0.6, 0.0, True),
    "N0_note_approved": (0.972, 0.0, 0.3, 0.7, False),
    "N0_note_denied": (0.981, 0.0, 0.0, 1.0, False),
    "N0_note_needs_review": (0.982, 0.4, 0.6, 0.0, False),
    "N1_reason_approved": (0.828, 0.0, 0.3, 0.7, False),
    "N1_reason_denied": (0.96, 0.2, 0.0, 0.8, False),
    "N1_reason_needs_review": (0.828, 0.4, 0.6, 0.0, False),
    "R1_disqualifying_flag": (0.976, 0.2, 0.0, 0.8, False),
    "R3_fee_unpaid": (0.921, 0.0, 0.0, 1.0, False),
    "R4_revoked_sponsor": (0.931, 0.5, 0.0, 0.5, False),
    "R5_soft_embargo_world": (0.894, 0.3, 0.0, 0.7, False),
    "R6_stale_arrival": (0.892, 0.0, 0.0, 1.0, False),
    "R7_transit_visa": (0.899, 0.0, 0.0, 1.0, False),
    "R8_fee_unknown": (0.944, 0.0, 1.0, 0.0, False),
    "R8_fee_unread": (0.4, 0.73, 0.27, 0.0, True),
    "R9_arrival_not_visible": (0.679, 0.44, 0.56, 0.0, True),
    "R10_review_flags": (0.902, 0.0, 1.0, 0.0, False),
    "R11_default_approve": (0.949, 0.0, 1.0, 0.0, False),
    "R12_flags_unread": (0.283, 0.79, 0.21, 0.0, True),
    "R12_visa_unread": (0.648, 1.0, 0.0, 0.0, True),
    "R12_world_unread": (0.5, 0.4, 0.6, 0.0, True),
    "R12_sponsor_unread": (0.648, 1.0, 0.0, 0.0, True),
    "FALLBACK_error": (0.35, 0.4, 0.6, 0.0, True),
}
OTHER_PATH = (0.5, 0.4, 0.6, 0.0, True)
CONF_FLOOR, CONF_CEIL = 0.05, 0.97
UNDERDETERMINED = ("R8_fee_unread", "R9_arrival_not_visible", "R12_flags_unread", "R12_visa_unread", "R12_world_unread", "R12_sponsor_unread")

REASONS = (
    "Ambiguous packet.",
    "Approval supported by surviving visible evidence and exception notes.",
    "Arrival date missing from trusted visible evidence.",
    "Clean or exception-qualified packet.",
    "Denial supported by damaged registry evidence and visible policy notes.",
    "Disqualifying risk flag:",
    "Embargo home world:",
    "Fee status unknown.",
    "Mandatory fee unpaid.",
    "Packet contains damaged or contradictory visible evidence.",
    "Review-only risk flag present:",
    "Revoked sponsor:",
    "Transit class cannot authorize declared work.",
)
REASON_LABELS = {
    "Approval supported by surviving visible evidence and exception notes.": "APPROVED",
    "Clean or exception-qualified packet.": "APPROVED",
    "Arrival date missing from trusted visible evidence.": "NEEDS_REVIEW",
    "Packet contains damaged or contradictory visible evidence.": "NEEDS_REVIEW",
    "Denial supported by damaged registry evidence and visible policy notes.": "DENIED",
    "Mandatory fee unpaid.": "DENIED",
    "Transit class cannot authorize declared work.": "DENIED",
}

#: Printed labels in the order in which they are tried, with their fields.
ANCHORS = (
    ("Declared Purpose", "declared_purpose"),
    ("Registry Name", "applicant_name"),
    ("Species Code", "species_code"),
    ("Species Match", "species_code"),
    ("Home World", "home_world"),
    ("Visa Class", "visa_class"),
    ("Sponsor ID", "sponsor_id"),
    ("Arrival Date", "arrival_date"),
    ("Observed flags", "risk_flags"),
    ("Fee Status", "fee_status"),
    ("Registry Status", "registry_status"),
    ("Waiver Code", "waiver_code"),
    ("Case ID", "case_id"),
    ("Applicant", "applicant_name"),
    ("Purpose", "declared_purpose"),
    ("Amount", "fee_amount"),
)
ANCHOR_MOST, ANCHOR_TIGHTER = 0.36, 0.08
CORRECTIONS = (("applicant", "applicant_name"), ("sponsor", "sponsor_id"), ("species", "species_code"), ("home world", "home_world"), ("world", "home_world"), ("visa", "visa_class"), ("arrival", "arrival_date"), ("purpose", "declared_purpose"), ("fee", "fee_status"))
HEADERS = (
    ("Manual Adjudicator Note", "note", 10),
    ("FORM I-8090: Extraterrestrial Work Authorization Intake", "intake", 20),
    ("MIB Fee Receipt", "fee_receipt", 25),
    ("FORM B-13: Biometric Scan Slip", "biometric", 30),
    ("Sponsor Attestation Letter", "attestation", 40),
    ("Planetary Registry Extract", "registry", 50),
    ("Work Authorization Intake", "intake", 20),
    ("Biometric Scan Slip", "biometric", 30),
)
HEADER_MOST, HEADER_LINES = 0.42, 10
TYPE_LABELS = {
    "intake": ("Applicant", "Arrival Date", "Case ID", "Declared Purpose", "Home World", "Species Code", "Sponsor ID", "Visa Class"),
    "registry": ("Arrival Date", "Home World", "Registry Name", "Registry Status", "Species Code"),
    "fee_receipt": ("Amount", "Case ID", "Fee Status", "Waiver Code"),
    "biometric": ("Applicant", "Case ID", "Observed flags", "Species Match"),
    "attestation": ("Applicant", "Purpose", "Sponsor ID", "Visa Class"),
}
TYPE_DISTINCTIVE = {"intake": ("Declared Purpose",), "registry": ("Registry Name", "Registry Status"), "fee_receipt": ("Amount", "Fee Status", "Waiver Code"), "biometric": ("Observed flags", "Species Match"), "attestation": ()}

#: Largest normalised distance of a match, by field, and what case its raw text is put in.
FIELD_MATCH = {"species_code": (SPECIES, 0.34, None), "home_world": (WORLDS, 0.30, None), "visa_class": (VISAS, 0.30, None), "declared_purpose": (PURPOSES, 0.34, None), "fee_status": (FEES, 0.34, "lower"), "registry_status": (REGISTRY_STATUSES, 0.35, "upper")}
MARGIN, FUSION_TIGHTER = 0.08, 0.75
NAME_PREFIXES = ("Ari", "Ixo", "Lu", "Mir", "Nex", "Ori", "Qor", "Sol", "Tek", "Vee", "Xan", "Za")
NAME_SUFFIXES = ("adane", "aix", "akesh", "amora", "anax", "aquell", "arix", "atari", "aul", "avara", "avoss", "azarn", "dane", "ix", "kesh", "mora", "nax", "quell", "rix", "tari", "ul", "vara", "voss", "zarn")
TRUE_PREFIXES = ("Ari", "Ixo", "Lu", "Mira", "Nex", "Ori", "Qor", "Sol", "Tek", "Vee", "Xan", "Za")
BASE_SUFFIXES = ("dane", "ix", "kesh", "mora", "nax", "quell", "rix", "tari", "ul", "vara", "voss", "zarn")
CONFUSIONS = ("0oO", "1iIl|!", "5sS", "8B", "2zZ", "6G", "9g", "ec", "rnm", "un", ".-_–—", "'`’", ",.", ":;")
FUSIONS = (("rn", "m"), ("cl", "d"), ("ii", "n"), ("vv", "w"), ("li", "h"), ("nn", "m"), ("ri", "n"))
FUSION_SINGLES = (("c", "o"), ("e", "a"))
CHEAP_INDEL = " .,:;|'`-_"
DIGIT_FROM, DIGIT_TO = "OoQDIli|!SsBZzGgATe", "0000111115582269478"

#: Patterns of printed values.
SPONSOR = r"SPN\s*[-–—._:]?\s*([0-9]{4})(?![0-9])"
SPONSOR_LOOSE = r"(?<![A-Za-z0-9])[SP]{0,2}N\s*[-–—]\s*([0-9]{4})(?![0-9])"
CASE = r"MIB\s*[-–—._:]?\s*([0-9]{6})(?![0-9])"
DATE = r"(20[0-9]{2})\s*[-–—._/]\s*([0-9]{2})\s*[-–—._/]\s*([0-9]{2})"
CAPTIONS = "SCAN IMAGE|PASSPORT IMAGE|REGISTRY IMAGE|MIB EYES ONLY|COPY ARTIFACT|CASEWORK|COPY|FILED|ARCHIVE|MIB INTAKE"
CAPTION_RUN = rf"(?:\s*[|\[\](){{}}~™—–-]*\s*(?:{CAPTIONS})\s*[|\[\](){{}}~™.—–-]*\s*)+$"
FOOTER = r"Packet\s+(MIB-[0-9]{6,})\s*/\s*page"
FOOTER_UPPER = r"PACKET\s+MIB-[0-9]{6}\s*/\s*PAGE"
FINDING = r"finding\b[:.]?\s*([A-Z_ ]+?)[.,]"
#: Parts of "FINDING: LABEL", one of which a garbled line must show once digits are read as letters.
PHRASE_PARTS = ("FIND", "INDI", "NDIN", "DING", "ING:", "DENI", "NIED", "APPR", "OVED", "NEED", "EEDS", "REVI", "VIEW")
GATE_LETTERS = str.maketrans("1|!05826", "IIIOSBZG")

FIELD_WEIGHTS = {"applicant_name": 5, "species_code": 6, "home_world": 5, "visa_class": 5, "sponsor_id": 5, "arrival_date": 4, "declared_purpose": 3, "risk_flags": 8, "fee_status": 4}
SHRINKAGE = 10


def path_stats(spark: SparkSession) -> DataFrame:
    """path, accuracy, share_a, share_d, share_r, pinned; a few dozen rows."""
    return spark.createDataFrame([(p, *v) for p, v in PATHS.items()], "path string, accuracy double, share_a double, share_d double, share_r double, pinned boolean")


def quoted(values) -> str:
    """Values as a list of SQL strings."""
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)

# Fixed values of second looks.
FOOTER_LINE = r"^(Packet MIB-[0-9]{6,} / page \d+|Synthetic hiring challenge document)$"
FOOTER_WORDS = ("packet", "page", "synthetic", "hiring", "challenge", "document")
TEMPLATE_WORD = (
    r"(?i)\b(applicant|species|sponsor|arrival|observed|finding|registry|visa|home|purpose|amount|waiver|status|receipt"
    r"|intake|biometric|attestation|adjudicator)\b"
)
SPONSOR_TEXT = r"(?i)sponsor|spn[\s\-–—._:]*[0-9]"
LOAD_PAGES, REVIEW_PAGES, SYNTHESIS_PAGES = 20, 20, 6
PAGE_STRIPS, FIELD_STRIPS = 6, 3
READER_SCALE, ROW_REACH = 0.85, 18.0
HEAD_CEILING = 0.90
HEADS = {
    "R8_fee_unread": ("discharge_fee", "fee_status"),
    "R9_arrival_not_visible": ("discharge_arrival", "arrival_on_intake"),
    "R12_sponsor_unread": ("discharge_sole_gap", "sponsor_id"),
    "R12_visa_unread": ("discharge_sole_gap", "visa_class"),
}
GRID = {"jpeg": (None, 58, 40), "blur": (0.0, 1.5, 3.0, 4.5), "skew": (0.0, 0.8), "noise": (0.0, 12.0)}
WELD_LEAST_HEIGHT, WELD_SHIFTS, WELD_MARGIN = 14, (12, 900), 1.15
