"""Byte-level BPE against the tiktoken library, with a property test of pre-tokenisation against the pattern."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from evidentia.llm import byte_bpe

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut(texts):
    points = np.array([ord(c) for t in texts for c in t], dtype=np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    begins = byte_bpe.boundaries(points, at[:-1][at[:-1] < len(points)])
    joined, ends = "".join(texts), [*begins.tolist(), len(points)]
    return [joined[a:b] for a, b in zip(ends, ends[1:])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="aZsé'tmdrevl19 \n\t\r 　!.$'\U0001f600漢२", max_size=80), max_size=6))
def test_boundaries_equal_the_pattern(texts):
    assert cut(texts) == [p for t in texts for p in PIECES.findall(t)]


def test_products_are_associative():
    p, n = byte_bpe._PRODUCT, len(byte_bpe._PRODUCT)
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(0, n, (3, 2000))
    assert (p[p[a, b], c] == p[a, p[b, c]]).all()


TEXTS = [
    None,
    "",
    " ",
    "it's I'll we've you're ''s 's!'s 'S",
    "word  two   \n\n three\t\t x",
    "a" * 3000,
    "<|endoftext|> naïve 漢字 ١٢٣ 😀😀",
    " x  y \r\n z",
    "Is and retitioning ouen the of, nterti thorreou ndernt. " * 500,
    "Is and retitioning ouen the of, nterti thorreou ndernt. " * 500,
]


def test_ids_and_offsets_equal_the_library(library):
    own = byte_bpe.codec(FILE)
    ids, at = own.encode(pa.array(TEXTS, pa.string()))
    back, places = own.decode(ids.astype(np.int64))
    for i, t in enumerate(TEXTS):
        mine = ids[at[i] : at[i + 1]].tolist()
        assert mine == library.encode_ordinary(t or "")
        assert back[places[at[i]] : places[at[i + 1]]].tobytes() == (t or "").encode()


def test_query_over_documents(spark, library):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "mine") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in byte_bpe.query(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, r in got.items():
        t = TEXTS[3 if i is None else i] or ""
        ids = library.encode_ordinary(t)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert byte_bpe.query(docs.limit(0)).count() == 0
