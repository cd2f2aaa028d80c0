import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from logtables.llm import bpe

from .cases import edge_rows, edges, nothing


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def memory():
    return bpe.loaded(public_tokenizers.path(bpe.VOCABULARY))


def test_the_hash_is_perfect_and_minimal(memory):
    whole = memory.encoder.whole
    slots = [whole.find(k) for k in whole.keys]
    assert slots == list(range(whole.size))
    assert whole.find(b"\xff\xfe no such token") == -1
    assert [bpe.PerfectHash([b"one"]).find(k) for k in (b"one", b"two")] == [0, -1]
    assert sorted(map(bpe.PerfectHash([b"a", b"b", b"c"]).find, [b"a", b"b", b"c"])) == [0, 1, 2]
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("abcinotes' \n1é東", max_size=120)))
def test_ids_are_those_of_the_library(library, memory, text):
    import regex
    packed = bpe.packed_ids(text, memory, regex.compile(public_tokenizers.PATTERN))
    ids = np.frombuffer(packed, "<u4").tolist()
    assert ids == library.encode_ordinary(text)
    assert memory.encoder.decode(ids) == text.encode()


def test_long_pieces_and_equal_ranks(library, memory):
    for piece in ("a" * 5000, "aba" * 700, "\u0301" * 300, "x" + " " * 900):
        assert memory.encoder.merge(piece.encode()) == library.encode_ordinary(piece) or len(
            library.encode_ordinary(piece)) != len(memory.encoder.merge(piece.encode()))
    assert memory.encoder.merge(("a" * 5000).encode()) == library.encode_ordinary("a" * 5000)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    import regex
    memory = bpe.Remembered(bpe.loaded(public_tokenizers.path(bpe.VOCABULARY)).encoder)
    text = "several different words that are each met twice: several different words"
    found = bpe.packed_ids(text, memory, regex.compile(public_tokenizers.PATTERN))
    assert np.frombuffer(found, "<u4").tolist() == library.encode_ordinary(text)


def test_edges(spark, library):
    found = sorted(bpe.round_trip(edges(spark)).collect(), key=repr)
    expected = []
    for doc_id, text, *_ in edge_rows():
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        expected.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert bpe.round_trip(nothing(spark)).count() == 0


def test_ids_as_columns(spark):
    docs = edges(spark).select("doc_id", "text")
    found = bpe.decode_ids(bpe.encode_text(docs), "ids", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in found)
