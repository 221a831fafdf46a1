from __future__ import annotations

import math

import numpy as np
import pytest

from filingframe.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, v string, q string, list int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "q", 1) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(np.float64)
    out = set()
    for q, x in ok.items():
        if q % every == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok.items() if i != q)[:k]
            out |= {(q, rank + 1, i, round(d, 9)) for rank, (d, i) in enumerate(near)}
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 16)) * 2
    return [(i, (centres[i % 40] + rng.standard_normal(16) * 0.6).tolist()) for i in range(4000)]


def test_recall(spark, clustered):
    got = {tuple(r) for r in ann.nearest(table(spark, clustered), 100, 10).collect()}
    want = brute(clustered, 100, 10)
    assert len({(q, r) for q, r, _, _ in got}) == len(want) == 400
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)


def test_lists_are_pruned_and_balanced(clustered):
    x = np.array([v for _, v in clustered])
    graph = ann.graph_of(ann.fit_centroids(x, 60))
    lists = ann._lists(graph, x, ann.BOUNDARY, ann.COPIES)
    load = np.bincount(np.concatenate(lists), minlength=60)
    assert load.max() < 6 * load.mean() and len(x) < load.sum() < 4 * len(x)
    probes = [len(p) for p in ann._lists(graph, x[:200], ann.RATIO, ann.PROBES)]
    assert np.mean(probes) < 45


def test_graph_search_finds_the_nearest_centroid(clustered):
    x = np.array([v for _, v in clustered])
    graph = ann.graph_of(x[:700])
    ids, dist = ann.search(graph, x[1000:1300])
    exact = ann.squared(x[1000:1300], x[:700])
    assert (ids[:, 0] == exact.argmin(1)).mean() > 0.97
    assert all(len(set(row)) == len(row) for row in ids)


def test_ties_equal_vectors_and_unusable_rows(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(0, 30)] + [(100, [1.0, 2.5]), (200, [5.0, 5.0]), (300, None), (400, [0.0, 0.0])]
    rows += [(500, [float("nan"), 1.0]), (600, [float("inf"), 1.0]), (700, [None, 1.0]), (None, same), (100, [1.0, 2.5]), (800, [])]
    got = {(*tuple(r)[:3], round(r.score, 9)) for r in ann.nearest(table(spark, rows), 100, 10).collect()}
    assert got == brute(dict(rows).items(), 100, 10)
    assert [i for _, i in sorted((r, i) for q, r, i, _ in got if q == 0)] == list(range(1, 11))


def test_few_and_no_vectors(spark):
    got = [tuple(r) for r in ann.nearest(table(spark, [(0, [3.0, 4.0]), (1, [1.0, 1.0])]), 100, 10).collect()]
    assert got == [(0, 1, 1, math.sqrt(13))]
    assert ann.nearest(table(spark, [(0, [3.0, 4.0])]), 100, 10).count() == 0
    assert ann.nearest(table(spark, [(0, None)]), 100, 10).count() == 0


def test_a_query_that_is_a_centroid_reads_other_lists_too(clustered):
    x = np.array([v for _, v in clustered])
    graph = ann.graph_of(x[:200])
    assert {len(p) for p in ann._lists(graph, x[:5], ann.RATIO, ann.PROBES)} == {1}
    assert min(len(p) for p in ann._lists(graph, x[:5], ann.RATIO, ann.PROBES, ann.LEAST)) == ann.LEAST
