from __future__ import annotations

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from filingframe.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = tc.read_pieces(PATH)


def brute(word):
    """Best score and fewest tokens of a pre-token, without a trie."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        s, n = best[end - 1]
        found = [(s + tc.BYTE * size, -(n + size))]
        for start in range(end):
            own = PIECES.get(word[start:end])
            if own is not None:
                found.append((best[start][0] + own, -(best[start][1] + 1)))
        s, n = max(found)
        best.append((s, -n))
    return best[-1][1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=12) | st.sampled_from(["the", "there", "thereby", "中文", "😀😀", "ththth"]), max_size=8))
def test_counts_are_those_of_every_word_alone(words):
    text = " ".join(words)
    trie = tc.Trie(PIECES)
    for _ in range(2):
        assert trie.count(text) == (len(text.split()), sum(brute(tc.MARK + w) for w in text.split()))


def test_prefixes_are_shared():
    trie = tc.Trie(PIECES)
    trie.count("therefore")
    nodes = len(trie.score)
    trie.count("there therefo therefore")
    assert len(trie.score) == nodes
    trie.count("therefores")
    assert len(trie.score) == nodes + 1


def test_a_full_trie_starts_anew(monkeypatch):
    monkeypatch.setattr(tc, "NODES", 20)
    trie = tc.Trie(PIECES)
    texts = ["alpha beta gamma", "delta epsilon zeta eta", "alpha theta"]
    for t in texts * 2:
        assert trie.count(t)[1] == sum(brute(tc.MARK + w) for w in t.split())


def test_table(awkward, nothing):
    rows = tc.count_tokens(awkward, PATH).collect()
    want = [(r.doc_id, len((r.text or "").split()), sum(brute(tc.MARK + w) for w in (r.text or "").split() if len(w) < 1000)) for r in awkward.filter("doc_id is null or doc_id not in (11)").collect()]
    got = [tuple(r) for r in rows if r.doc_id != 11]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert tc.count_tokens(nothing, PATH).count() == 0
