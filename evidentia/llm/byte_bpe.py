"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Pre-tokenisation finds where pieces begin without a regex. Each code point of a batch gets a class from a table: letter,
number, white space, other; with the little that must be known of the places after it, a symbol. A symbol is a function
of the scanner's eight states, and the functions that symbols compose to are few, so a table holds all their products.
Composition is associative: blocks of places are composed side by side, their products scanned by doubling, and every block
then runs from its own starting state. Texts lie in a row; a text's first symbol forgets the state before it.

The slices between boundaries go to a cached pair merging. Offsets of tokens are kept, so decoding restores the bytes and
each token's place.

Null and empty texts have no tokens. Lone surrogates cannot stand in Arrow strings. Repeated rows give equal results; a null
id is allowed; an empty table gives no rows; further columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from evidentia.llm.arrow import map_slices
from evidentia.llm.textscan import utf8

RANKS_FILE = "byte_bpe_50k.tiktoken"
#: Pieces remembered by a worker; the memory of merges is emptied when it is full.
CACHE_PIECES = 400_000
#: Longer pieces are merged but not remembered.
CACHE_BYTES = 64

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

# Symbols of the scan: what a place holds, with the little that must be known of what follows it in its text.
# _SHORT2, _SHORT3: an apostrophe with the rest of a contraction; _MID: white space before white space or the end;
# _JOIN: a space before something else; _LONE: other white space before something else. Plus _FIRST at a text's start.
_O, _L, _N, _SHORT2, _SHORT3, _MID, _JOIN, _LONE = range(8)
_FIRST = 8
# States after a place: within a run of others, letters, numbers or white space; after a joining space; after a finished
# piece; with 1 or 2 more letters of a contraction to come.
_RUN_O, _RUN_L, _RUN_N, _RUN_W, _JOINED, _FRESH, _ONE_MORE, _TWO_MORE = range(8)


def _moves() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state], and begins[symbol, state]: whether a piece begins at the symbol."""
    to, begins = np.zeros((16, 8), np.uint8), np.zeros((16, 8), bool)
    runs = {_O: _RUN_O, _L: _RUN_L, _N: _RUN_N, _MID: _RUN_W}
    for symbol in range(16):
        for came in range(8):
            state = _FRESH if symbol >= _FIRST else came
            s = symbol % _FIRST
            if s == _L and state in (_ONE_MORE, _TWO_MORE):
                to[symbol, came] = _FRESH if state == _ONE_MORE else _ONE_MORE
            elif s in (_SHORT2, _SHORT3):
                inside = state in (_RUN_O, _JOINED)
                begins[symbol, came] = not inside
                to[symbol, came] = _RUN_O if inside else _ONE_MORE if s == _SHORT2 else _TWO_MORE
            elif s in runs:
                begins[symbol, came] = not (state == runs[s] or (state == _JOINED and s != _MID))
                to[symbol, came] = runs[s]
            else:
                begins[symbol, came] = True
                to[symbol, came] = _JOINED if s == _JOIN else _FRESH
    return to, begins


def _monoid(to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions of states that symbols compose to: (of each symbol, product table, each function's images)."""
    place: dict[tuple[int, ...], int] = {}
    for f in [tuple(range(8)), *map(tuple, to.tolist())]:
        place.setdefault(f, len(place))
    todo = list(place)
    own = todo[1:]
    while todo:
        f = todo.pop()
        for g in own:
            h = tuple(g[x] for x in f)
            if h not in place:
                place[h] = len(place)
                todo.append(h)
    every = list(place)
    product = np.array([[place[tuple(g[x] for x in f)] for g in every] for f in every], dtype=np.uint16)
    return np.array([place[tuple(f)] for f in to.tolist()], dtype=np.uint16), product, np.array(every, dtype=np.uint8)


_TO, _BEGINS = _moves()
_FUNCTION, _PRODUCT, _IMAGES = _monoid(_TO)
#: Places in a block of the scan.
_BLOCK = 64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, from the running Python's Unicode tables."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = NUMBER
    # Code points with the White_Space property.
    out[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The scan's symbol at each place; first marks the starts of texts and has one place more, the end."""
    n = len(points)
    kind = classes()[points]
    out = np.array([_O, _L, _N, _MID], np.uint8)[kind]
    last = np.ones(n, dtype=bool)
    last[:-1] = first[1:n]
    before_other = ~last
    before_other[:-1] &= kind[1:] != SPACE
    ends_run = (kind == SPACE) & before_other
    out[ends_run] = np.where(points[ends_run] == 32, _JOIN, _LONE)
    at = np.flatnonzero((points == 39) & ~last)
    if len(at):
        one = points[at + 1]
        more = np.where(last[at + 1], 0, points[np.minimum(at + 2, n - 1)])
        two = np.isin(one, [ord(c) for c in "stmd"])
        three = (((one == ord("r")) | (one == ord("v"))) & (more == ord("e"))) | ((one == ord("l")) & (more == ord("l")))
        out[at[two]], out[at[three]] = _SHORT2, _SHORT3
    out[first[:n]] += _FIRST
    return out


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted places where a piece begins. points: code points of all texts in a row; starts: each text's first place.

    Blocks of places are composed all at once, their products scanned by doubling, and each block run from its state.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    first[0] = first[n] = True
    rows = -(-n // _BLOCK)
    padded = np.full(rows * _BLOCK, _FIRST + _MID, np.uint8)
    padded[:n] = symbols(points, first)
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    whole = _FUNCTION[columns[0]]
    flat, width = _PRODUCT.ravel(), len(_PRODUCT)
    for column in columns[1:]:
        whole = flat[whole.astype(np.intp) * width + _FUNCTION[column]]
    span = 1
    while span < rows:
        joined = whole.copy()
        joined[span:] = _PRODUCT[whole[:-span], whole[span:]]
        whole, span = joined, span * 2
    state = np.full(rows, _FRESH, np.uint8)
    state[1:] = _IMAGES[whole[:-1], _FRESH]
    begins = np.empty((_BLOCK, rows), dtype=bool)
    to, does = _TO.ravel(), _BEGINS.ravel()
    for k, column in enumerate(columns):
        at = (column << 3) | state
        begins[k] = does[at]
        state = to[at]
    return np.flatnonzero(begins.T.ravel()[:n])


class Codec:
    """Encodes by a rank file and decodes back."""

    def __init__(self, file: str):
        with open(file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Joins the neighbouring pair of lowest rank, the first of equals, until no pair has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) > 256:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 60:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same for long pieces: a heap of pairs over a linked list, n log n."""
        ranks, n = self.ranks, len(piece)
        stop = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = stop[i]
            if not alive[i] or j >= n or stop[j] != end or not alive[j]:
                continue
            alive[j] = False
            stop[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, stop[end]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
                heapq.heappush(heap, (r, k, end))
        return tuple(ranks[piece[i : stop[i]]] for i in range(n) if alive[i])

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts in a row, and where each text's begin; the last offset is the end."""
        body, at = utf8(text)
        lead = (body & 0xC0) != 0x80
        byte_of = np.flatnonzero(lead)
        points = code_points(body, byte_of)
        starts = np.searchsorted(byte_of, at)
        begins = boundaries(points, starts[:-1][starts[:-1] < len(points)])
        cuts = np.append(byte_of[begins], len(body)) if len(points) else np.zeros(1, np.int64)
        raw, cache, merge = body.tobytes(), self.cache, self.merge
        where = cuts.tolist()
        out: list[tuple[int, ...]] = []
        put = out.append
        for a, b in zip(where, where[1:], strict=False):
            piece = raw[a:b]
            ids = cache.get(piece)
            if ids is None:
                ids = merge(piece)
                if b - a <= CACHE_BYTES:
                    if len(cache) >= CACHE_PIECES:
                        cache.clear()
                    cache[piece] = ids
            put(ids)
        sizes = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        flat = np.fromiter(chain.from_iterable(out), dtype=np.uint32, count=int(sizes.sum()))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat, ends[np.searchsorted(cuts[:-1], at)] if len(out) else np.zeros(len(at), np.int64)

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in order of id, and where each one's begin."""
        most = max(self.bytes_of) + 1
        every = [self.bytes_of.get(i, b"") for i in range(most)]
        return np.frombuffer(b"".join(every), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in every])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and the offset of each id's bytes; the last offset is the end."""
        table, at = self._table
        sizes = at[ids + 1] - at[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(at[ids] - ends[:-1], sizes) + np.arange(ends[-1])
        return table[source], ends

    @property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_made"):
            self._made = self.token_bytes()
        return self._made


def code_points(body: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Code points of valid UTF-8; lead: places of first bytes."""
    value = body[lead].astype(np.uint32)
    if len(lead) == len(body):
        return value
    size = np.diff(np.append(lead, len(body)))
    for length, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        rows = np.flatnonzero(size == length)
        if len(rows):
            got = value[rows] & mask
            for k in range(1, length):
                got = (got << np.uint32(6)) | (body[lead[rows] + k] & 0x3F)
            value[rows] = got
    return value


@lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    return Codec(file)


def query(docs: DataFrame, file: str | None = None) -> DataFrame:
    """op8: every document's ids and what they decode to, as digests."""
    path = file or public_tokenizers.path(RANKS_FILE)

    def work(part: pa.RecordBatch) -> dict:
        own = codec(path)
        ids, at = own.encode(part.column("text"))
        back, places = own.decode(ids.astype(np.int64))
        raw_ids, raw_back, bounds, ends = ids.astype("<u4").tobytes(), back.tobytes(), at.tolist(), places[at].tolist()
        sha = lambda raw, a, b: hashlib.sha256(raw[a:b]).hexdigest()
        return {
            "doc_id": part.column("doc_id"),
            "n_tokens": pa.array(np.diff(at)),
            "ids_sha256": pa.array([sha(raw_ids, 4 * a, 4 * b) for a, b in zip(bounds, bounds[1:], strict=False)], pa.string()),
            "decoded_sha256": pa.array([sha(raw_back, a, b) for a, b in zip(ends, ends[1:], strict=False)], pa.string()),
        }

    return map_slices(docs.select("doc_id", "text"), work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
