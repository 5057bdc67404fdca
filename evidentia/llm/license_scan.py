"""License scans: an Aho-Corasick automaton over words, and a shunting-yard parser for licence expressions.

A text's words are its runs of digits, small letters and non-ASCII bytes after A-Z are lower-cased. The automaton runs once
over the words joined by single spaces and finds all phrases at any place, overlapping ones too. Base phrases give base
labels; the method's own phrases (notices) and identifier tags give further ones. After an identifier tag
(`spdx license identifier` as words) the raw line is read as an expression of identifiers with AND, OR, WITH and
brackets; the shunting-yard parser turns it to postfix and evaluates it to labels, and to whether every way of satisfying
it is known. Unreadable expressions add the label `unparsed`.

score: 1 - 2^-(places of base phrases + 2 * further labels), at most 1; 0 without any place.

Null and empty texts have no words, no labels and score 0. Ties have no role: labels are sorted and distinct. Repeated rows
give equal results; a null id is allowed; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evidentia.llm.arrow import map_slices
from evidentia.llm.textscan import utf8

# Phrases and labels that results must agree with.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Phrases of the method's own.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "licensed under the apache": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu general public license": "gpl",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "isc license": "isc",
    "unlicense": "unlicense",
    "eclipse public license": "epl",
    "no part of this publication may be reproduced": "reserved",
}
TAG = "spdx license identifier"
_TAG_LINE = re.compile(r"spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier[^0-9A-Za-z(\n]*([^\n]*)", re.I)
_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
#: Beginnings of identifiers, longest first where one begins another, with their labels.
FAMILIES = (("cc-by-sa", "cc-by-sa"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by", "cc-by"), ("cc0", "cc0"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"), ("mpl", "mpl"), ("isc", "isc"), ("epl", "epl"), ("unlicense", "unlicense"))
BINDING = {"or": 1, "and": 2, "with": 3}

_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in sorted({*BASE, *NOTICES, TAG}):
        out.add_word(f" {phrase} ", phrase)
    out.make_automaton()
    return out


def postfix(text: str) -> list[str] | None:
    """The longest readable expression at the start of text, in postfix order; None if there is none.

    A word that cannot go on the expression ends it; a bracket left open makes it unreadable.
    """
    out: list[str] = []
    held: list[str] = []
    wants, at = True, 0
    while m := _TOKEN.match(text, at):
        token, low = m[1], m[1].lower()
        if wants:
            if token == "(":
                held.append(token)
            elif token == ")" or low in BINDING:
                return None
            else:
                out.append(token)
                wants = False
        elif low in BINDING:
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[low]:
                out.append(held.pop())
            held.append(low)
            wants = True
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                break
            held.pop()
        else:
            break
        at = m.end()
    if wants or "(" in held:
        return None
    return out + held[::-1]


def family(identifier: str) -> str | None:
    low = identifier.lower()
    return next((label for head, label in FAMILIES if low.startswith(head)), None)


def evaluate(items: list[str]) -> tuple[set[str], bool]:
    """Labels of a postfix expression, and whether it can be satisfied by known licences alone: all of AND, one of OR."""
    stack: list[tuple[set[str], bool]] = []
    for item in items:
        if item in BINDING:
            right, left = stack.pop(), stack.pop()
            if item == "with":
                stack.append((left[0] | {"exception"}, left[1]))
            else:
                stack.append((left[0] | right[0], (left[1] and right[1]) if item == "and" else (left[1] or right[1])))
        else:
            label = family(item)
            stack.append(({label} if label else set(), bool(label)))
    return stack[-1]


def tag_labels(text: str) -> set[str]:
    """Labels of all identifier tags in a text."""
    out: set[str] = set()
    for m in _TAG_LINE.finditer(text):
        items = postfix(m[1])
        if items is None:
            out.add("unparsed")
        else:
            labels, known = evaluate(items)
            out |= labels | (set() if known else {"unknown"})
    return out


def scan(raw: bytes) -> tuple[int, int, int | None, int | None, list[str], list[str], float]:
    """n_words, n_base, first_word, last_word, base labels, all labels, score of one text's UTF-8 bytes."""
    words = raw.translate(_BYTES).split()
    joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
    places, base, more, tagged = [], set(), set(), False
    for end, phrase in automaton().iter(joined):
        if phrase in BASE:
            places.append(end - len(phrase) - 1)
            base.add(BASE[phrase])
        if phrase in NOTICES:
            more.add(NOTICES[phrase])
        tagged = tagged or phrase == TAG
    if tagged:
        more |= tag_labels(raw.decode("utf-8", "replace"))
    ends = [joined.count(" ", 0, p) for p in (min(places), max(places))] if places else [None, None]
    extra = more - base
    weight = len(places) + 2 * len(extra)
    return len(words), len(places), *ends, sorted(base), sorted(base | more), 1 - 0.5 ** min(weight, 60)


def query(docs: DataFrame) -> DataFrame:
    """op5: every document's licence places and labels."""

    def work(part: pa.RecordBatch) -> dict:
        body, at = utf8(part.column("text"))
        raw, bounds = body.tobytes(), at.tolist()
        n, k, first, last, base, every, score = zip(*(scan(raw[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)), strict=True)
        said = lambda lists: pa.array([",".join(x) for x in lists], pa.string())
        return {
            "doc_id": part.column("doc_id"),
            "n_words": pa.array(n, pa.int64()),
            "n_base": pa.array(k, pa.int64()),
            "first_word": pa.array(first, pa.int64()),
            "last_word": pa.array(last, pa.int64()),
            "base_labels": said(base),
            "labels": said(every),
            "score": pa.array(np.array(score, dtype=float)),
        }

    return map_slices(docs.select("doc_id", "text"), work, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
