from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from filingframe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer


def check(docs, library):
    out = packing.pack(docs, PATH).toPandas()
    # pieces of a sequence follow one another without gaps, up to the window
    ordered = out.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    sizes = out.groupby("sequence_id").length.sum()
    assert sizes.max() <= packing.WINDOW and (out.length > 0).all()
    return out, sizes


def test_every_id_lies_in_one_piece(make_docs, awkward, library):
    docs = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    out, sizes = check(docs, library)
    assert not any(n & (n - 1) and n != packing.WINDOW for n in sizes)  # nothing is padded
    for row in docs.collect():
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, packing.END], "<u4")
        own = out[out.doc_id == row.doc_id].sort_values("start")
        assert (own.start == own.length.cumsum() - own.length).all() and own.length.sum() == len(ids)
        assert (own.doc_tokens == len(ids)).all()
        for piece in own.itertuples():
            assert piece.ids_crc32 == zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes())


def test_repeated_rows_and_null_ids_are_packed_as_often_as_they_occur(awkward, nothing, library):
    out, _ = check(awkward, library)
    tokens = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in awkward.collect())
    assert out.length.sum() == tokens
    assert packing.pack(nothing, PATH).count() == 0


def test_one_length_shared_by_most_documents(make_docs, library):
    _, sizes = check(make_docs(["alpha beta"] * 3000 + ["gamma " * k for k in range(1, 200)]), library)
    assert not any(n & (n - 1) and n != packing.WINDOW for n in sizes)


def test_chunks_encode_like_the_whole_text(library):
    encoder = packing.WordEncoder(PATH)
    for text in ["It's 12 o'clock, é.;", "İstanbul. Σσς, ß", "a\x85b\x1cc d", "<|endoftext|> x.", "x" * 300, ""]:
        ids = np.frombuffer(encoder.ids(text.encode()), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_combinations_fill_the_window():
    found = packing.combinations(8, 3)
    assert all(sum(c) == 8 and len(c) <= 3 and list(c) == sorted(c, reverse=True) for c in found)
    assert len(found) == len(set(found)) == 10  # partitions of 8 into at most three parts


def test_nonnegative_least_squares_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((8, 12)), rng.random(8) * 4 - 1
        x = packing.nonnegative_least_squares(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and (gradient > -1e-6).all() and abs(gradient @ x) < 1e-6


def test_plan_places_no_rank_twice():
    histogram = {u: 1000 // u for u in range(1, 65)}
    plan = packing.solve(histogram)
    taken = set()
    for u, n in histogram.items():
        sequence, slot = plan.place(np.full(n, u), np.arange(n))
        places = {(s, t) for s, t in zip(sequence, slot, strict=True) if s >= 0}
        assert len(places) == (sequence >= 0).sum() and not places & taken
        taken |= places
