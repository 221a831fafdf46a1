from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from filingframe.llm import components, simhash
from tests_words import words


def brute_fingerprint(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    """``prints``: (doc_id, fp); least doc_id reachable for each fp."""
    fps = sorted({f for _, f in prints})
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[find(b)] = find(a)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {f: least.get(find(f)) for f in fps}


@pytest.mark.parametrize("size", [4, 5])
def test_awkward_rows(awkward, size):
    rows = simhash.near_duplicates(awkward, size=size, bits=4).collect()
    want = [(r.doc_id, brute_fingerprint(r.text, size)) for r in awkward.collect()]
    classes = brute_components(want, 4)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows]
    assert sorted(got, key=str) == sorted(((d, f, classes[f]) for d, f in want), key=str)


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing, size=4, bits=4).count() == 0
    assert simhash.keep_one(nothing).columns == nothing.columns


@pytest.fixture
def clustered():
    """Chains and clusters of fingerprints, some far apart."""
    rng = random.Random(1)
    fps = {0}
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(25):
            fps.add(f)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                f ^= 1 << b
    centre = rng.getrandbits(64)
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    return sorted(fps)


@pytest.mark.parametrize("piece", [7, 1024])
def test_no_link_is_lost(spark, clustered, monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)  # large buckets meet piece by piece
    signed = [f - (1 << 64) if f >> 63 else f for f in clustered]
    fps = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.near_links(simhash._buckets(fps), 4)
    roots = {r.node: r.root for r in components.roots(links).collect()}
    mine, want = {}, {}
    classes = brute_components(list(enumerate(clustered)), 4)
    for f, s in zip(clustered, signed, strict=True):
        mine.setdefault(roots.get(s, s), set()).add(f)
        want.setdefault(classes[f], set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_pivots_discard_only_what_differs():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 63, 150).astype(np.uint64))
    table = np.bitwise_count(fps[None, :] ^ simhash._pivots()[:, None]).astype(np.int8)
    left, right = np.triu_indices(300, 1)
    found = simhash.links(fps, table, left, right, 4)
    assert set(found) == set(np.flatnonzero(np.bitwise_count(fps[left] ^ fps[right]) <= 4))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (None, 7), (3, 2)], "a long, b long")
    roots = {r.node: r.root for r in components.roots(edges).collect()}
    assert roots == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
    assert components.roots(edges.filter("false")).count() == 0


def brute_kept(rows, bits=4):
    """Least (null id, id, text hash unknown) of each component of distinct texts, by brute force."""
    prints = {t: brute_fingerprint(t or "", 4) for _, t in rows}
    classes = brute_components([(i, prints[t]) for i, (_, t) in enumerate(rows)], bits)
    groups = {}
    for i, t in rows:
        groups.setdefault(classes[prints[t]], []).append((i is None, i or 0, t))
    return groups


def test_one_of_each_group_stays(make_docs):
    base = words(11, 400)
    near = base.split()
    near[200] = "changed"
    rows = [(0, base), (1, " ".join(near)), (2, base), (3, words(12, 400)), (4, None), (5, ""), (3, words(13, 400)), (None, base), (None, words(14, 50)), (6, words(14, 50)), (None, words(15, 50)), (None, words(15, 50))]
    for order in (rows, rows[::-1]):
        docs = make_docs(order)
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        got = [(r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect()]
        want = [min(g, key=lambda x: x[:2])[:2] for g in brute_kept(rows).values()]
        assert sorted(x[:2] for x in got) == sorted(want)
        # unlike texts of one id both stay
        assert {words(12, 400), words(13, 400)} <= {t for _, _, t in got}


def test_columns_that_clash_and_map_columns(make_docs):
    docs = make_docs([words(1, 60), words(1, 60), words(2, 60)]).selectExpr("*", "1 as _number", "2 as _doc_id", "3 as _text_hash", "map('a', 1) as m")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_only_similar_texts_are_linked(make_docs):
    """Pairs on both sides of a Jaccard similarity of 0.8, which twelve bits do not tell apart."""
    rng = random.Random(4)

    def grams(text):
        own = text.split()
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}

    texts = []
    for i in range(120):
        own = words(1000 + i, 300).split()
        edited = own.copy()
        for at in rng.sample(range(300), 3 + i % 10):
            edited[at] = f"edit{at}"
        texts += [" ".join(own), " ".join(edited)]
    pairs = [(grams(a), grams(b)) for a, b in zip(texts[::2], texts[1::2], strict=True)]
    similar = [5 * len(a & b) >= 4 * len(a | b) for a, b in pairs]
    assert 20 < sum(similar) < 100
    prints = [[brute_fingerprint(t, 5) for t in texts[i : i + 2]] for i in range(0, 240, 2)]
    near = [(a ^ b).bit_count() <= 12 for a, b in prints]
    assert any(s and not n for s, n in zip(similar, near, strict=True))  # copies beyond twelve bits
    assert any(n and not s for s, n in zip(similar, near, strict=True))  # and others within
    kept = {r.doc_id for r in simhash.keep_one(make_docs(texts), 5, simhash.SIMILAR_BITS).collect()}
    assert kept == set(range(240)) - {2 * i + 1 for i, s in enumerate(similar) if s}


@pytest.mark.parametrize("members", [7, 4096])
def test_large_groups_are_compared_whole(make_docs, monkeypatch, members):
    monkeypatch.setattr(simhash, "MEMBERS", members)
    base = words(77, 400).split()
    texts = []
    for i in range(40):
        own = base.copy()
        own[10 * i] = f"own{i}"
        texts.append(" ".join(own))
    texts += ["lone " + words(78, 100), (None, " ".join(base))]
    rows = simhash.near_duplicates(make_docs(texts)).collect()
    assert {r.component_id for r in rows if r.doc_id != 40} == {0} and len(rows) == 42
