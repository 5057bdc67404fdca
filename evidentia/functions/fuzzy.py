"""String distances that know what OCR confuses, as Arrow-batched functions of distinct pairs.

weighted_distance: edits cost 1, confusable letters 0.2, marks that appear and vanish 0.35; case is free.
fusion_distance: besides, one letter against the two it looks like costs 0.4, and so do c/o and e/a.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia import dims

_FUSED = tuple(p for a, b in dims.FUSIONS for p in ((a, b), (b, a)))
#: Letters whose substitutions may cost less than 1, and what they cost, plainly and with look-alikes; the last row stands for all others.
_LETTERS = {c: i for i, c in enumerate(sorted({c for group in dims.CONFUSIONS for c in group} | {c for p in dims.FUSION_SINGLES for c in p}))}
#: Pairs that are worked on at once.
_PAIRS = 20_000


def _costs(fused: bool) -> np.ndarray:
    out = np.ones((len(_LETTERS) + 1,) * 2)
    for group in dims.CONFUSIONS:
        own = [_LETTERS[c] for c in group]  # texts are looked up in lower case, so a group's capitals are never met
        out[np.ix_(own, own)] = 0.2
    for x, y in dims.FUSION_SINGLES if fused else ():
        x, y = _LETTERS[x], _LETTERS[y]
        out[[x, y], [y, x]] = np.minimum(out[[x, y], [y, x]], 0.4)
    return out


_PLAIN, _LOOKALIKE = _costs(False), _costs(True)


class _Coded:
    """Texts as a matrix of letters' numbers: lower-cased letters, those of _LETTERS first. Equal texts are spelt out once."""

    def __init__(self, texts: list[str], numbers: dict[str, int]):
        known = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        of = np.fromiter((known[t] for t in texts), np.int64, len(texts))
        size = np.array([len(t) for t in known], np.int64)
        self.width = int(size.max(initial=0))
        inside = np.arange(self.width) < size[:, None]
        letters = "".join(known)
        code = np.full(inside.shape, -1, np.int64)
        code[inside] = [numbers.setdefault(c.lower(), len(numbers)) for c in letters]
        indel = np.ones(inside.shape)
        indel[inside] = [0.35 if c in dims.CHEAP_INDEL else 1.0 for c in letters]
        self.size, self.code, self.indel = size[of], code[of], indel[of]

    def ends(self, part: str, numbers: dict[str, int]) -> np.ndarray:
        """Whether part stands before each place (from the first letter on)."""
        out = np.ones(self.code.shape, bool)
        for back, c in enumerate(reversed(part)):
            shifted = np.full(self.code.shape, -1, np.int64)
            shifted[:, back:] = self.code[:, : self.width - back]
            out &= shifted == numbers.get(c, -2)
        return out


def _some(a: list[str], b: list[str], fused: bool) -> np.ndarray:
    numbers = dict(_LETTERS)
    x, y = _Coded(a, numbers), _Coded(b, numbers)
    every, cost, last = np.arange(len(a)), _LOOKALIKE if fused else _PLAIN, len(_LETTERS)
    ends = [(len(s), len(t), x.ends(s, numbers), y.ends(t, numbers)) for s, t in _FUSED] if fused else []
    first = np.zeros((len(a), y.width + 1))
    first[:, 1:] = np.cumsum(y.indel if fused else np.ones_like(y.indel), axis=1)
    rows, out = [first], first[every, y.size]
    for i in range(x.width):
        above, letter, drop = rows[-1], x.code[:, i : i + 1], x.indel[:, i : i + 1]
        swap = np.where(letter == y.code, 0.0, cost[np.minimum(letter, last), np.minimum(y.code, last)])
        best = np.minimum(above[:, 1:] + drop, above[:, :-1] + swap)
        for s, t, here, there in ends:
            if s <= i + 1:
                at = here[:, i : i + 1] & there[:, t - 1 :]
                best[:, t - 1 :] = np.where(at, np.minimum(best[:, t - 1 :], rows[-s][:, : y.width + 1 - t] + 0.4), best[:, t - 1 :])
        row = np.empty_like(above)
        row[:, :1] = above[:, :1] + drop
        for j in range(y.width):
            np.minimum(best[:, j], row[:, j] + y.indel[:, j], out=row[:, j + 1])
        rows = [rows[-1], row]
        done = x.size == i + 1
        out[done] = row[every[done], y.size[done]]
    return out


def distances(a: list[str], b: list[str], fused: bool = False) -> np.ndarray:
    """The cheapest way from each text of a to its counterpart in b, all pairs side by side.

    The first row of the plain form charges 1 for each letter of b, of whatever kind; equal texts are at 0.
    """
    parts = [_some(a[i : i + _PAIRS], b[i : i + _PAIRS], fused) for i in range(0, len(a), _PAIRS)]
    out = np.concatenate(parts) if parts else np.zeros(0)
    return np.where([x == y for x, y in zip(a, b, strict=True)], 0.0, out) if len(out) else out


def table(texts: list[str], vocabulary: list[str], fused: bool = False) -> np.ndarray:
    """Distances of every text (a row each) to every entry."""
    a = [t for t in texts for _ in vocabulary]
    return distances(a, list(vocabulary) * len(texts), fused).reshape(len(texts), len(vocabulary))


@lru_cache(maxsize=1 << 16)
def distance(a: str, b: str, fused: bool = False) -> float:
    return float(distances([a], [b], fused)[0])


def _paired(f):
    """A column of f over the lists of two columns; nulls stay null."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out, known = pd.Series(np.nan, index=a.index), a.notna() & b.notna()
        out[known] = f(a[known].tolist(), b[known].tolist())
        return out.astype("Float64").where(known, None)

    return F.pandas_udf(run, "double")


def weighted_distance(a: str | Column, b: str | Column) -> Column:
    return _paired(distances)(a, b)


def fusion_distance(a: str | Column, b: str | Column) -> Column:
    return _paired(lambda x, y: distances(x, y, True))(a, b)


def ratio_bound(a: str, b: str) -> float:
    common = sum((Counter(a) & Counter(b)).values())
    return 200.0 * common / (min(len(a), len(b)) + common) if common else 0.0


def alignment(needle: str, hay: str) -> tuple[float, int]:
    """Best ratio (0 to 100) of needle with a stretch of hay as long as it, among those that begin where matching blocks would put it, and where that stretch ends."""
    if not needle or not hay:
        return 0.0, 0
    blocks = SequenceMatcher(None, needle, hay, autojunk=False)
    if len(needle) > len(hay):
        return 100.0 * blocks.ratio(), len(hay)
    best, at = 0.0, 0
    for start in sorted({0, *(max(m.b - m.a, 0) for m in blocks.get_matching_blocks())}):
        ratio = SequenceMatcher(None, needle, hay[start : start + len(needle)], autojunk=False).ratio()
        if ratio > best:
            best, at = ratio, start
    return 100.0 * best, min(at + len(needle), len(hay))


def partial_ratio(a: str, b: str) -> float:
    return alignment(*sorted((a, b), key=len))[0]


def partial_ratio_of(needle: str | Column, hay: str | Column) -> Column:
    """The needle within hay, whichever is shorter."""
    return _paired(lambda x, y: [alignment(n, h)[0] for n, h in zip(x, y, strict=True)])(needle, hay)


def ratio_bound_column(a: Column, b: Column) -> Column:
    """ratio_bound in built-in functions, to filter pairs before their ratio is computed."""
    chars = lambda s: F.split(s, "")
    letters = F.array_distinct(F.filter(chars(a), lambda c: c != ""))
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    common = F.aggregate(letters, F.lit(0), lambda n, c: (n + F.least(count(a, c), count(b, c))).cast("int"))
    return F.when(common > 0, 200.0 * common / (F.least(F.length(a), F.length(b)) + common)).otherwise(0.0)
