"""Repairs of printed values, as expressions of built-in functions. White space and digits are ASCII's."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia import dims
from evidentia.functions.fuzzy import distance

FOOTER = dims.FOOTER


def repair_digits(text: Column) -> Column:
    """Letters that OCR takes digits for, as digits."""
    return F.translate(text, dims.DIGIT_FROM, dims.DIGIT_TO)


def _after_prefix(text: Column, prefix: str) -> Column:
    """text with digits repaired, but for what goes up to the prefix."""
    at = F.instr(F.upper(text), prefix)
    end = at + len(prefix) - 1
    kept = F.concat(F.substring(text, F.lit(1), end), repair_digits(F.substring(text, end + 1, F.length(text))))
    return F.when(at > 0, kept).otherwise(repair_digits(text))


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def repair_sponsor_id(raw: Column, loose: bool = False) -> Column:
    text = F.trim(raw)
    options = [_found(text, dims.SPONSOR), _found(_after_prefix(text, "SPN"), dims.SPONSOR), *([_found(text, dims.SPONSOR_LOOSE)] if loose else [])]
    return F.concat(F.lit("SPN-"), F.coalesce(*options))


def repair_case_id(raw: Column) -> Column:
    return F.concat(F.lit("MIB-"), F.coalesce(_found(raw, dims.CASE), _found(_after_prefix(raw, "MIB"), dims.CASE)))


def year_repairs() -> dict[str, str]:
    """What each year of this century is a misread of, by the rule: a later one of 2026, else the one year that is clearly nearest."""
    out = {}
    for y in (str(y) for y in range(2000, 2100)):
        (near, best), (far, _) = sorted((distance(y, v), v) for v in ("2025", "2026"))
        if y in ("2027", "2028", "2029"):
            out[y] = "2026"
        elif near == 0 or (near <= 1.0 and far - near >= 0.5):
            out[y] = best
    return out


def repair_date(raw: Column) -> Column:
    """An ISO day of 2025 or 2026, null if none can be read."""
    text = F.trim(raw)
    text = F.when(text.rlike(dims.DATE), text).otherwise(repair_digits(text))
    years = reduce(lambda m, kv: m + [F.lit(kv[0]), F.lit(kv[1])], year_repairs().items(), [])
    year = F.element_at(F.create_map(*years), F.regexp_extract(text, dims.DATE, 1))
    day = F.concat_ws("-", year, F.regexp_extract(text, dims.DATE, 2), F.regexp_extract(text, dims.DATE, 3))
    return F.when(year.isNotNull(), F.date_format(day.try_cast("date"), "yyyy-MM-dd"))


def strip_captions(raw: Column) -> Column:
    """Without the captions that pages print behind values, however many."""
    return F.trim(F.regexp_replace(F.trim(raw), dims.CAPTION_RUN, ""))


def strip_footer(text: Column) -> Column:
    """Without the page footer: its phrases, its words, and case ids."""
    phrases = r"(?i)packet\s+mib[-\s.:]*[0-9]{6}\s*/?\s*page(\s+[0-9]+(\s+of\s+[0-9]+)?)?|synthetic\s+hiring\s+challenge\s+document"
    words = F.split(F.regexp_replace(text, phrases, " "), r"\s+")
    footer = ("packet", "page", "synthetic", "hiring", "challenge", "document", "/", "")
    return F.array_join(F.filter(words, lambda t: ~F.lower(t).isin(*footer) & ~t.rlike(r"(?i)^mib[-\s.:]?[0-9]{6}$")), " ")


def parse_correction(text: Column) -> Column:
    """struct(fld, value) of a line "manual correction: X is V"; the first keyword that stands before " is " names the field."""
    body = F.rtrim(F.trim(_found(text, r"(?i)manual\s+correction\b[:.]?\s*(.+)")), F.lit("."))
    head = F.substring_index(F.lower(body), " is ", 1)
    at = F.instr(body, " is ")
    value = F.when(at > 0, F.nullif(F.trim(F.substring(body, at + 4, F.length(body))), F.lit("")))
    fld = reduce(lambda out, kf: F.when(head.contains(kf[0]), kf[1]).otherwise(out), reversed(dims.CORRECTIONS), F.lit(None).cast("string"))
    return F.when(fld.isNotNull() & value.isNotNull(), F.struct(fld.alias("fld"), value.alias("value")))


def normal_label(value: Column) -> Column:
    """Lower case and single spaces, to compare a field with its label."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " ")))


def clean_token(text: Column) -> Column:
    return F.lower(F.btrim(text, F.lit(" :;.,|-_'\"`")))
