from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from filingframe.llm import collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
SCHEMA = "lang string, text string, w1 long, word string, id long, shard long, phrase string"


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(lang, t, 1, "w", 1, 1, "p") for lang, t in rows], SCHEMA)

    return build


def brute(rows, least, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        own = counts.setdefault(lang, Counter())
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scores = []
        for p, a in found.items():
            score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            longer = [x for q, x in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * x >= 80 * a for x in longer):
                scores.append((-score, -a, " ".join(p).encode(), left, right))
        scores.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(scores[:top])]
    return sorted(out)


def found(df, **bounds):
    out = collocations.collocations(df, **bounds)
    assert out.columns == COLUMNS
    assert all(kind == "bigint" for name, kind in out.dtypes if name not in ("lang", "phrase"))
    return sorted(tuple(r) for r in out.collect())


def sentences(seed, count):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "city", "of", "é", "É", "z\x01", "z", " x", "don't"]
    return " ".join(rng.choices(words, [9, 3, 4, 4, 4, 6, 1, 1, 1, 1, 1, 1])[0] + rng.choice(["", "", "", ".", ",", "\n", "\t", " "]) for _ in range(count))


@pytest.mark.parametrize("size", [1 << 20, 50])
def test_equals_brute_force(make, monkeypatch, size):
    monkeypatch.setattr(collocations, "SHARD_WORDS", size)
    monkeypatch.setattr(collocations, "SLICE_ENTRIES", max(8, size // 4))
    rows = [(lang, sentences(i, 120)) for i in range(30) for lang in ("en", None, "und", "fr")[: 1 + i % 4]]
    rows += [("en", None), ("en", ""), (None, "."), ("en", "new york city hall " * 40), ("xx", "a a a a a a a a"), ("yy", "one")]
    assert found(make(rows), least=5) == brute(rows, 5)


def test_top_and_ties(make):
    rows = [("en", f"b{i} a{i}. c{i} d{i}!") for i in range(9) for _ in range(4)]
    assert found(make(rows), least=4, top=5) == brute(rows, 4, 5)


def test_awkward_rows_and_empty_table(make, awkward, nothing):
    given = [(r.lang, r.text) for r in awkward.collect()]
    assert found(awkward) == brute(given, 30)
    assert found(nothing) == []
    assert found(make([("en", "no such thing")])) == []


@pytest.mark.parametrize(("words", "bits", "slice_bits"), [(2, 1, 9), (2, 17, 0), (3, 17, 5), (4, 17, 7), (4, 32, 3), (3, 31, 20)])
def test_filters_lose_nothing(words, bits, slice_bits):
    layout = collocations.Layout(words, bits, slice_bits)
    rng = np.random.default_rng(words * 100 + bits)
    ids = rng.integers(0, min(1 << bits, 40), 3000).astype(np.uint64) + np.uint64(0 if bits < 8 else (1 << bits) - 41)
    ids[rng.random(3000) < 0.1] = 0
    want = Counter(
        tuple(map(int, ids[i : i + words])) for i in range(len(ids) - words + 1) if (ids[i : i + words] > 0).all()
    )
    got = Counter()
    for own, data in collocations.slices(ids, layout):
        left, right, counts = collocations.read_filter(data, layout)
        left = left | (np.uint64(own) << np.uint64(layout.rest_bits))
        keys = layout.unpack(*layout.permute(left, right, undo=True))
        got.update(dict(zip(zip(*[k.tolist() for k in keys], strict=True), counts.tolist(), strict=True)))
    assert got == want


def test_large_counts_survive_the_filter():
    layout = collocations.Layout(2, 4, 0)
    ids = np.array([1, 2] * 5000, np.uint64)
    ((_, data),) = collocations.slices(ids, layout)
    assert sorted(collocations.read_filter(data, layout)[2].tolist()) == [4999, 5000]


def test_scores_pass_64_bits(spark):
    huge = 9_000_000_000_000_000_000
    rows = [("en", 2, 1, 2, 0, 0, huge // 2), ("en", 1, 1, 0, 0, 0, huge // 2), ("en", 1, 2, 0, 0, 0, huge // 2 + 7)]
    phrases = spark.createDataFrame(rows, "lang string, words int, w1 long, w2 long, w3 long, w4 long, a long")
    (row,) = collocations.scored(phrases).collect()
    assert (row.score, row.l, row.r) == (2_000_000 * (huge // 2) // (huge + 7), huge // 2, huge // 2 + 7)


def test_sql_twin(make):
    import duckdb

    rows = [(lang, sentences(i, 400)) for i, lang in enumerate(["en", None, "und", "fr"] * 3)] + [("en", None)]
    con = duckdb.connect()
    con.register("documents", make(rows).select("lang", "text").toArrow())
    assert sorted(con.execute(collocations.SQL).fetchall()) == brute(rows, 30)
