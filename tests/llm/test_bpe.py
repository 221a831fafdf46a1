from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from filingframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN, remembered=50)

ALPHABET = st.sampled_from(["a", "the", "é", " ", "  ", "\n", "\t", "'s", "'", "12", ".", "　", "\x85", "\x1c", "中", "😀", "́", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=20).map("".join) | st.text(max_size=30))
def test_ids_are_those_of_the_library(text):
    ids = CODEC.ids(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("n", [1, 2, 3, 15, 16, 17, 18, 33, 255, 256, 257, 4000])
def test_pieces_of_every_tree_height(n):
    for text in ("ab" * n, "a" * n, "".join(chr(97 + i * i % 26) for i in range(n))):
        assert bpe.encode_piece(text.encode(), RANKS) == LIBRARY.encode_ordinary(text)


def test_table(awkward, nothing):
    out = bpe.digests(awkward, PATH, public_tokenizers.PATTERN).toPandas()
    want = []
    for row in awkward.collect():
        ids = LIBRARY.encode_ordinary(row.text or "")
        written = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((row.doc_id, len(ids), written, hashlib.sha256((row.text or "").encode()).hexdigest()))
    got = [(None if r[0] != r[0] else int(r[0]), *r[1:]) for r in out.itertuples(index=False, name=None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.digests(nothing, PATH, public_tokenizers.PATTERN).count() == 0


def test_general_form(make_docs):
    rows = bpe.encode(make_docs(["hello world", None]), PATH, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert rows[0].ids == LIBRARY.encode_ordinary("hello world") and bytes(rows[0].decoded) == b"hello world"
    assert rows[1].ids == [] and rows[1].n_tokens == 0
