"""Near duplicates by SimHash fingerprints and pivot distance tables.

Fingerprints are linked within a number of differing bits. Pairs are looked for
inside buckets: for ``MAX_BITS``, fingerprints that agree on two of six blocks of
bits (four differing bits leave at least two blocks untouched, so no link is
lost); for more bits, where blocks would hardly tell fingerprints apart,
documents that share the least shingles of a band under hashed orders. Inside a
bucket the table of Hamming distances to many reference fingerprints (pivots)
discards every pair that differs by more than the allowed bits in any
coordinate (the triangle inequality); survivors are verified bit by bit. A
bucket gives the links of a spanning forest, never all pairs.

For more bits such a link is only a candidate: documents that candidates join meet
again with their shingles, and a link needs a Jaccard similarity of ``SIMILAR``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from filingframe.llm import components
from filingframe.llm.common import fresh, short_batches, texts
from filingframe.session import materialise

MAX_BITS = 4
#: Blocks of the 64 bits; buckets agree on all blocks but MAX_BITS.
BLOCKS = 6
PIVOTS = 24
#: Jaccard similarity (sets of shingles) of a near copy, as a fraction.
SIMILAR = 4, 5
#: Bits that texts of that similarity exceed in one case of some 3,000, and bands and orders a
#: band with which two such texts meet with probability 0.998 or more.
SIMILAR_BITS, BANDS, ORDERS = 20, 12, 4
#: A bucket with more fingerprints is cut into pieces that meet pair by pair.
PIECE = 1024
#: Documents, and their shingles, that are compared by one task; larger groups are cut likewise.
MEMBERS, HELD = 4096, 1 << 22
#: Pairs whose shingles are compared in a round, besides one for each document.
ROUND = 1024
#: Shingles counted together, and pairs compared together: bounds of memory.
COUNTED, COMPARED = 1 << 16, 1 << 20
#: Rows of buckets gathered before they are compared.
GATHERED = 1 << 16

_digest = partial(xxhash.xxh64_intdigest, seed=42)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space."""
    return text.lower().split()


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def _orders(bands: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(9)
    odd = rng.integers(0, 1 << 63, bands * ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, bands * ORDERS, dtype=np.uint64)


def fingerprint(text: bytes, size: int, bands: int = 0) -> tuple[int, list[int]]:
    """Fingerprint, and a key for each band.

    A bit is set where over half of the shingle hashes, repeats included, have it.
    """
    hashes = map(_digest, shingles(words_of(text), size))
    ones, total = np.zeros(64, np.int64), 0
    factor, shift = _orders(bands)
    least = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    while block := list(itertools.islice(hashes, COUNTED)):
        values = np.array(block, np.uint64)
        bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
        total += len(block)
        for i in range(len(factor)):
            least[i] = min(least[i], (values * factor[i] ^ shift[i]).min())
    keys = [xxhash.xxh64_intdigest(least[i * ORDERS : (i + 1) * ORDERS].tobytes(), seed=i) for i in range(bands)]
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big"), keys


def same_words(text: bytes) -> int:
    """A number that texts share which differ in white space and the case of A-Z alone."""
    return _digest(b" ".join(words_of(text)))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Distinct shingle hashes in order."""
    hashes = map(_digest, shingles(words_of(text), size))
    return np.unique(np.fromiter(hashes, np.uint64))


def fingerprints(docs: DataFrame, size: int = 5, bands: int = 0) -> DataFrame:
    """``doc_id, fp, keys, same, shingles`` (signed 64 bits, and a number of words).

    Null texts and texts without words have fingerprint zero. ``same`` is that of
    ``same_words``; ``shingles`` bounds how many the text has.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).cast(pa.binary())
            found = [fingerprint(t.as_py(), size, bands) for t in values]
            same = np.array([same_words(t.as_py()) if bands else 0 for t in values], np.uint64).view(np.int64)
            count = [len(words_of(t.as_py())) if bands else 0 for t in values]
            fp = np.array([f for f, _ in found], np.uint64).view(np.int64)
            keys = [np.array(k, np.uint64).view(np.int64) for _, k in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(fp),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(same),
                    pa.array(count, pa.int64()),
                ],
                names=["doc_id", "fp", "keys", "same", "shingles"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, fp long, keys array<long>, same long, shingles long")


def _buckets(fps: DataFrame) -> DataFrame:
    """``bucket, fp``: one row for each choice of blocks that must agree."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in itertools.pairwise(edges)]

    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask

    chosen = [signed(sum(c)) for c in itertools.combinations(masks, BLOCKS - MAX_BITS)]

    def key(number: int, mask: int) -> Column:
        return F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask)))

    return fps.select(F.explode(F.array(*[key(i, m) for i, m in enumerate(chosen)])).alias("bucket"), "fp")


def _pieces(buckets: DataFrame) -> DataFrame:
    """``task, piece, fp``: buckets with company; large ones as all pairs of their pieces."""
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sized = buckets.join(sizes, "bucket")
    cuts = F.ceil(F.col("n") / PIECE)
    own = F.pmod(F.xxhash64("fp", F.lit(1)), cuts)
    small = sized.filter(F.col("n") <= PIECE).select(F.xxhash64("bucket").alias("task"), F.lit(0).alias("piece"), "fp")
    large = (
        sized.filter(F.col("n") > PIECE)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)))
        .select(
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            F.col("own").cast("int").alias("piece"),
            "fp",
        )
    )
    return small.union(large)


def _pivots() -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def links(fps: np.ndarray, table: np.ndarray, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Which of the pairs (left, right) differ in ``bits`` bits at most."""
    alive = np.arange(len(left))
    for column in table:  # each pivot discards what the ones before have left
        gap = column[left[alive]] - column[right[alive]]
        alive = alive[np.abs(gap) <= bits]
        if not len(alive):
            return alive
    return alive[np.bitwise_count(fps[left[alive]] ^ fps[right[alive]]) <= bits]


def _forest(nodes: int, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels (least node reachable) after the links are added to what the labels join."""
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        for side in (left, right):
            np.minimum.at(label, before[side], low)
            np.minimum.at(label, side, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _pairs_of(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each group, in blocks of about COMPARED pairs."""
    ends = np.repeat(starts + sizes, sizes)
    rows = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, sizes, strict=True)]) if len(starts) else starts
    partners = ends - rows - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(rows):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + COMPARED, "right")))
        count = partners[at:stop]
        left = np.repeat(rows[at:stop], count)
        offset = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        yield left, left + 1 + offset
        at = stop


def _linked(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: links of each task as a forest of (fp, least fp)."""
    pivots = _pivots()

    def solve(task: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        sizes = np.diff(np.r_[starts, len(task)])
        table = np.bitwise_count(fps[None, :] ^ pivots[:, None]).astype(np.int8)
        label = np.arange(len(fps))
        busy = sizes > 1
        for left, right in _pairs_of(starts[busy], sizes[busy]):
            found = links(fps, table, left, right, bits)
            if len(found):
                label = _forest(len(fps), left[found], right[found], label)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        a, b = fps[moved].view(np.int64), fps[label[moved]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        if sum(len(t) for t, _ in held) >= GATHERED:
            task, fps = map(np.concatenate, zip(*held, strict=True))
            # the last task may go on in the next batch
            cut = int(np.searchsorted(task, task[-1]))
            if cut:
                yield solve(task[:cut], fps[:cut])
            held = [(task[cut:], fps[cut:])]
    task, fps = map(np.concatenate, zip(*held, strict=True)) if held else (np.zeros(0), np.zeros(0))
    if len(task):
        yield solve(task, fps)


def near_links(buckets: DataFrame, bits: int) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of a bucket within ``bits`` bits.

    ``buckets`` has ``bucket, fp`` without repeated rows.
    """
    pieces = _pieces(buckets).select("task", "fp")
    linked = partial(_linked, bits=bits)
    return pieces.repartition("task").sortWithinPartitions("task").mapInArrow(linked, "a long, b long").distinct()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of SIMILAR or more; empty sets are equal."""
    top, bottom = SIMILAR
    if bottom * min(len(a), len(b)) < top * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return bottom * both >= top * (len(a) + len(b) - both)


def _joined(fps: np.ndarray, sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Labels (least document) of the components of all pairs that are alike and within ``bits`` bits.

    Pairs that others have joined already are not compared.
    """
    table = np.bitwise_count(fps[None, :] ^ _pivots()[:, None]).astype(np.int8)
    label = np.arange(len(fps))
    for left, right in _pairs_of(np.array([0]), np.array([len(fps)])):
        found = links(fps, table, left, right, bits)
        left, right = left[found], right[found]
        while True:
            apart = label[left] != label[right]
            left, right = left[apart], right[apart]
            if not len(left):
                break
            # a pair of each component, and some more
            first = np.unique(label[left], return_index=True)[1]
            first = np.union1d(first, np.arange(min(ROUND, len(left))))
            same = [alike(sets[a], sets[b]) for a, b in zip(left[first], right[first], strict=True)]
            hit = first[np.array(same, bool)]
            if len(hit):
                label = _forest(len(fps), left[hit], right[hit], label)
            left, right = np.delete(left, first), np.delete(right, first)
    return label


def _verified(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: links of each task as a forest of (same, least same)."""

    def rows() -> Iterator[tuple[int, int, int, np.ndarray]]:
        for batch in batches:
            task, same, fp = (batch.column(i).to_pylist() for i in range(3))
            sets = (x.values.to_numpy() for x in batch.column(3))
            yield from zip(task, same, fp, sets, strict=True)

    for _, own in itertools.groupby(rows(), lambda row: row[0]):
        _, same, fp, sets = zip(*own, strict=True)
        label = _joined(np.array(fp, np.int64).view(np.uint64), list(sets), bits)
        moved = np.flatnonzero(label != np.arange(len(label)))
        a = np.array(same, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a[moved]), pa.array(a[label[moved]])], names=["a", "b"])


def similar_links(docs: DataFrame, prints: DataFrame, size: int, bits: int) -> DataFrame:
    """``a, b``: links between ``same`` of texts whose sets of shingles are alike.

    Documents within ``bits`` bits that share a band are candidates; whatever
    candidates join, step by step, is a group, in which all pairs within ``bits``
    bits are compared by their shingles. One document of each ``same`` brings them.
    """
    buckets = prints.select(F.explode("keys").alias("bucket"), "fp").distinct()
    roots = components.roots(near_links(buckets, bits)).select(F.col("node").alias("fp"), "root")
    nodes = prints.groupBy("same").agg(
        F.min("fp").alias("fp"), F.min("doc_id").alias("least"), F.max("shingles").alias("shingles")
    )
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    cuts = F.ceil(F.greatest(F.count("*") / MEMBERS, F.sum("shingles") / HELD))
    groups = nodes.groupBy("root").agg(F.greatest(cuts, F.lit(1)).alias("cuts"), F.count("*").alias("n"))
    members = nodes.join(groups.filter("n > 1"), "root").select("least", "same", "fp", "root", "cuts")
    text = texts(docs)
    brought = text.join(members, text["doc_id"].eqNullSafe(members["least"])).select("text", "same", "fp", "root", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).cast(pa.binary()).to_pylist()
            # rows that share the doc_id may have another text
            mine = np.array([same_words(t) for t in values], np.uint64).view(np.int64) == batch.column(1).to_numpy()
            sets = [shingle_set(t, size).view(np.int64) for t, own in zip(values, mine, strict=True) if own]
            kept = batch.select([1, 2, 3, 4]).filter(pa.array(mine, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sets, pa.list_(pa.int64()))], names=["same", "fp", "root", "cuts", "shingles"]
            )

    held = brought.mapInArrow(run, "same long, fp long, root long, cuts long, shingles array<long>")
    # a document of a large group meets all of its pieces
    pieces = (
        held.withColumn("own", F.pmod(F.xxhash64("same", F.lit(1)), "cuts"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
        .select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("task"), "same", "fp", "shingles")
    )
    verified = partial(_verified, bits=bits)
    return pieces.repartition("task").sortWithinPartitions("task").mapInArrow(verified, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, bits: int = SIMILAR_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links (null ids count
    only where a component has no other). Repeated rows give repeated results;
    texts without words all have fingerprint zero and are linked like any other.
    ``size`` is the number of words in a shingle. Up to MAX_BITS, all fingerprints
    that differ in ``bits`` bits at most are linked; for more, texts that share a band of
    shingles, within ``bits`` bits, and whose Jaccard similarity is SIMILAR or more.
    """
    exact = bits <= MAX_BITS
    prints = materialise(fingerprints(docs, size, 0 if exact else BANDS), "fingerprints")
    key = "fp" if exact else "same"
    least = prints.groupBy(key).agg(F.min("doc_id").alias("least"))
    found = near_links(_buckets(least.select("fp")), bits) if exact else similar_links(docs, prints, size, bits)
    roots = components.roots(found)
    whole = least.join(roots, least[key] == roots.node, "left").withColumn("root", F.coalesce("root", key))
    ids = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = whole.select(key, "root").join(ids, "root").select(key, "component_id")
    return prints.select("doc_id", "fp", "same").join(classes, key).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = 4, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    It is the row of least doc_id, null ids last, then of least text hash. So texts that share a
    doc_id are told apart, rows without id take part, and of rows that repeat in id
    and text one stays (least in its other columns). Null texts are empty texts, which
    are copies of each other and of all texts without words; an empty table stays empty.
    """
    own_id, own_hash, number = fresh(docs, "_doc_id", "_text_hash", "_number")
    # a text stands for itself here, whatever ids its rows have
    texts_ = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    classes = near_duplicates(texts_, size, bits).select(F.col("doc_id").alias(own_hash), "component_id").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"))
    # reduced before they meet, so a text with very many copies is one row
    first = docs.groupBy(F.xxhash64("text").alias(own_hash)).agg(F.min(place).alias("place"))
    kept = (
        first.join(classes, own_hash)
        .groupBy("component_id")
        .agg(F.min(F.struct("place.unnamed", "place.id", own_hash)).alias("one"))
        .select(F.col("one.id").alias(own_id), F.col(f"one.{own_hash}").alias(own_hash))
    )
    same = docs["doc_id"].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs["text"]) == F.col(own_hash))
    rest = [docs[f.name] for f in docs.schema.fields if f.name != "text" and not isinstance(f.dataType, MapType)]
    one = Window.partitionBy(docs["doc_id"], F.xxhash64(docs["text"])).orderBy(*rest)
    stay = docs.join(kept, same, "left_semi").withColumn(number, F.row_number().over(one))
    return stay.filter(F.col(number) == 1).drop(number)
