"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample by clustering that splits whatever grows
too large, so that lists come out balanced. Every distinct vector goes to its
nearest centroid and, near a boundary, to others nearly as close. Centroids are
found by searching a neighbour graph held in memory; a query reads the lists
whose centroids are within a distance ratio of the nearest one. Distances of
candidates are exact, in double precision.

Equal vectors are kept once with their least ids: of a set of equal vectors, no
query can return more than its own number of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.session import materialise

#: Vectors that the centroids are fitted on, vectors a list should hold, most centroids.
SAMPLE, LIST_SIZE, CENTROIDS = 20_000, 256, 4096
#: A vector goes to lists whose centroids are within this ratio of its nearest, this many at most.
BOUNDARY, COPIES = 1.12, 6
#: A query reads lists within this ratio, so many at most, and at least (one that is a centroid itself has ratio 0).
RATIO, PROBES, LEAST = 1.35, 48, 16
#: Neighbours of a centroid in the graph, and nodes that its search keeps.
DEGREE, BEAM = 16, 64
#: Rows of a list, and queries, that meet in one task.
PART = 4096


def usable(column: str) -> Column:
    """Vectors that take part: not null, not zero, all components finite."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """About ``count`` centroids whose clusters hold nearly equal shares of the sample.

    In each round a row prefers centroids with few rows: the distance is raised with
    the share of rows that the centroid had in the round before.
    """
    rng = np.random.default_rng(seed)
    count = max(1, min(count, len(sample)))
    centroids = sample[rng.choice(len(sample), count, replace=False)].copy()
    raised = np.zeros(count)
    even = len(sample) / count
    for _ in range(rounds):
        load, own = np.zeros(count), np.empty(len(sample), np.int64)
        spread = None
        for at in range(0, len(sample), 2048):
            d = squared(sample[at : at + 2048], centroids)
            spread = d.min(1).mean() if spread is None else spread
            own[at : at + 2048] = (d + spread * raised).argmin(1)
        load = np.bincount(own, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        filled = load > 0
        centroids[filled] = sums[filled] / load[filled, None]
        # empty centroids move to rows of the largest clusters
        for c in np.flatnonzero(~filled):
            crowded = np.flatnonzero(own == load.argmax())
            centroids[c] = sample[rng.choice(crowded)]
            load[load.argmax()] //= 2
        raised = 0.15 * np.log1p(np.maximum(load / even - 1, 0))
    return centroids


@dataclass
class Graph:
    """Centroids and, for each, its nearest others and a few far ones."""

    centroids: np.ndarray
    near: np.ndarray
    entries: np.ndarray


def graph_of(centroids: np.ndarray, degree: int = DEGREE, seed: int = 0) -> Graph:
    n = len(centroids)
    rng = np.random.default_rng(seed)
    d = squared(centroids, centroids)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, : min(degree, max(1, n - 1))]
    if n == 1:
        near = np.zeros((1, 1), np.int64)
    # chance links make the graph connected and its paths short
    near = np.concatenate([near, rng.integers(0, n, (n, 4))], axis=1)
    return Graph(centroids, near, np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64)))


def search(graph: Graph, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search from the entries: the ``beam`` nearest nodes found and their squared distances.

    Rows advance together; a row rests when all nodes in its beam have been expanded.
    """
    rows, n = len(x), len(graph.centroids)
    beam = min(beam, n)
    width = beam + graph.near.shape[1]
    ids = np.full((rows, beam), -1)
    dist = np.full((rows, beam), np.inf)
    start = graph.entries[:beam]
    ids[:, : len(start)] = start
    dist[:, : len(start)] = squared(x, graph.centroids[start])
    seen = np.zeros((rows, n), bool)
    seen[:, start] = True
    expanded = np.zeros((rows, beam), bool)
    while True:
        open_cost = np.where(expanded | (ids < 0), np.inf, dist)
        best = open_cost.argmin(1)
        busy = np.flatnonzero(np.isfinite(open_cost[np.arange(rows), best]))
        if not len(busy):
            order = np.argsort(dist, axis=1, kind="stable")
            return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        expanded[busy, best[busy]] = True
        more = graph.near[ids[busy, best[busy]]]
        fresh = ~seen[busy[:, None], more]
        seen[busy[:, None], more] = True
        d = ((graph.centroids[more] - x[busy][:, None, :]) ** 2).sum(2)
        d = np.where(fresh, d, np.inf)
        all_ids = np.concatenate([ids[busy], np.where(fresh, more, -1)], axis=1)
        all_dist = np.concatenate([dist[busy], d], axis=1)
        all_done = np.concatenate([expanded[busy], np.zeros_like(fresh)], axis=1)
        # the same node may be a neighbour twice
        repeated = np.zeros_like(all_dist, bool)
        by_id = np.argsort(all_ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(all_ids, by_id, 1)
        np.put_along_axis(repeated, by_id[:, 1:], (sorted_ids[:, 1:] == sorted_ids[:, :-1]) & (sorted_ids[:, 1:] >= 0), 1)
        all_dist[repeated] = np.inf
        all_ids[repeated] = -1
        keep = np.argpartition(all_dist, min(beam, width - 1) - 1, axis=1)[:, :beam]
        ids[busy] = np.take_along_axis(all_ids, keep, 1)
        dist[busy] = np.take_along_axis(all_dist, keep, 1)
        expanded[busy] = np.take_along_axis(all_done, keep, 1)


def _lists(graph: Graph, x: np.ndarray, ratio: float, most: int, least: int = 1) -> list[np.ndarray]:
    """For each row the lists within ``ratio`` of its nearest centroid, nearest first, ``least`` of them at least."""
    ids, dist = search(graph, x)
    near = dist <= dist[:, :1] * ratio * ratio
    near[:, :least] = True
    return [i[n & (i >= 0)][:most] for i, n in zip(ids, near, strict=True)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _with_lists(rows: DataFrame, shared, ratio: float, most: int, least: int = 1) -> DataFrame:  # noqa: ANN001
    """One row for each of a vector's lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            lists = _lists(shared.value, _matrix(batch.column(names.index("v"))), ratio, most, least)
            at = np.repeat(np.arange(len(lists)), list(map(len, lists)))
            out = pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(at)) for i in range(batch.num_columns)], names=names
            )
            yield out.append_column("list", pa.array(np.concatenate(lists).astype(np.int64)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, list long")


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """``key, v, ids``: distinct usable vectors with their ``keep`` least ids, ascending.

    Vectors of another dimension than the most frequent one (the larger of equally
    frequent ones) take no part.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v")).filter(usable("embedding")).filter("vec_id is not null")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("v") == (sizes.n if sizes else -1)).distinct()
    order = Window.partitionBy("v").orderBy("vec_id")
    return (
        rows.withColumn("at", F.row_number().over(order))
        .filter(F.col("at") <= keep)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.xxhash64("v").alias("key"), "v", "ids")
    )


def fit(distinct: DataFrame, sample: int = SAMPLE, list_size: int = LIST_SIZE) -> Graph | None:
    """Centroids of a bounded sample of the distinct vectors, chosen by hash; None without vectors."""
    n = distinct.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64("v", F.lit(8)), F.lit(1_000_000)) / 1_000_000
    chosen = distinct.filter(draw < min(1.0, sample / n)).select("v").limit(sample).toArrow()
    if not chosen.num_rows:
        chosen = distinct.select("v").limit(sample).toArrow()
    x = _matrix(chosen.column(0).combine_chunks())
    x = x[np.lexsort(x.T[::-1])]  # the order in which rows arrive does not count
    return graph_of(fit_centroids(x, min(CENTROIDS, -(-n // list_size))))


def _nearest_in_list(k: int):
    """Exact distances of one part of a list to one part of its queries."""

    def run(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"q": [], "vec_id": [], "score": []})
        v = np.stack(rows.v.to_numpy()).astype(np.float64)
        out = []
        for q, own in zip(queries.q, queries.v, strict=True):
            d = np.sqrt(((v - np.asarray(own, np.float64)) ** 2).sum(1))
            near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
            ids = rows.ids.to_numpy()[near]
            flat = np.concatenate(ids)
            score = np.repeat(d[near], list(map(len, ids)))
            first = np.lexsort((flat, score))[:k]
            out.append(pd.DataFrame({"q": q, "vec_id": flat[first], "score": score[first]}))
        return pd.concat(out)

    return run


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors of each whose id is divisible by ``every``.

    ``score`` is the Euclidean distance; equal distances go to the smaller id, and a
    vector is no neighbour of itself. Vectors that are null, zero, hold null or
    non-finite components, or have no id take no part; rows that repeat count once.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    # one more than k, for a vector's own id
    distinct = materialise(distinct_vectors(vectors, k + 1), "vectors")
    graph = fit(distinct)
    if graph is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(graph)  # at most CENTROIDS rows
    asked = (
        vectors.filter((F.col("vec_id") % every == 0) & usable("embedding"))
        .select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("v"))
        .distinct()
    )
    questions = asked.select("v").distinct().select(F.xxhash64("v").alias("q"), "v")
    index = _with_lists(distinct.select("v", "ids"), shared, BOUNDARY, COPIES)
    sizes = index.groupBy("list").count().withColumn("parts", F.ceil(F.col("count") / PART)).select("list", "parts")
    # a large list is dealt over parts, and every query of the list goes to all of them
    dealt = index.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))
    probing = _with_lists(questions, shared, RATIO, PROBES, LEAST)
    probes = probing.join(sizes, "list").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    found = (
        probes.groupBy("list", "part")
        .cogroup(dealt.select("list", "part", "v", "ids").groupBy("list", "part"))
        .applyInPandas(_nearest_in_list(k + 1), "q long, vec_id long, score double")
    )
    # a boundary vector is found in several lists
    best = Window.partitionBy("q").orderBy("score", "vec_id")
    top = found.distinct().withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k + 1).drop("at")
    named = asked.select("query_id", F.xxhash64("v").alias("q"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.join(top, "q")
        .filter("query_id != vec_id")
        .withColumn("rank", F.row_number().over(final).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
