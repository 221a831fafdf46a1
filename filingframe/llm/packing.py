"""Packing documents into training windows by non-negative least squares.

Whole windows are cut off long documents. The remainders are counted in units of
``WINDOW / UNITS`` tokens; all combinations of at most ``DEPTH`` units' lengths
that fill a window are enumerated, and non-negative least squares finds how often
each must be repeated to meet the histogram. Counts are rounded down. Documents
take the places of the combinations by their rank among remainders of their
length; what has no place (the residual) is poured, cut where needed, into the
gaps that rounding up to units left, and then into windows of its own.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filingframe.llm.common import remembered, short_batches, texts
from filingframe.session import materialise

WINDOW, END = 4096, 2
UNITS, DEPTH = 64, 5
#: Share of each combination's count that is used; the rest fills gaps.
USED = 0.96
#: Documents that are ranked, and later poured, together.
GROUP = 4000
#: Chunks and runs of marks whose ids a worker remembers, and the longest chunk.
REMEMBERED, MARKS, LONGEST = 600_000, 1000, 64


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it is visible, else one beyond Latin-1."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class WordEncoder(dict):
    """Packed ids (little-endian, 32 bits) by chunk between ASCII white space.

    Holds for vocabularies that drop white space: no token crosses a chunk. A chunk
    that is not there yet is encoded when it is looked up.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word of Latin-1 letters: nothing is left to do but to lower and to merge it."""
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [token.id for token in self.merges(word)]).tobytes()

    def _mark(self, mark: str) -> bytes:
        packed = self.marks.get(mark)
        if packed is None:
            packed = self._encode(mark)
            if len(self.marks) < MARKS:
                self.marks[mark] = packed
        return packed

    def __missing__(self, chunk: bytes) -> bytes:
        packed = self.older.get(chunk)
        if packed is None:
            text = chunk.decode()
            if len(chunk) > LONGEST:
                return self._encode(text)
            word = text.rstrip(".,;:")
            # letters and the marks after them are split from each other (beyond Latin-1, lowering may add marks)
            if word.isalpha() and max(word) < "\u0100":
                packed = self._word(word)
                if len(word) < len(text):
                    packed += self._mark(text[len(word) :])
            else:
                packed = self._encode(text)
        self[chunk] = packed
        return packed

    def ids(self, text: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


def tokenise(docs: DataFrame, path: str, end: int = END, window: int = WINDOW) -> DataFrame:
    """``doc_id, doc_tokens, whole, rest``: checksums of whole windows, ids of the remainder.

    A null text is empty; every document ends with the id ``end``.
    """
    short_batches(docs.sparkSession)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = remembered(WordEncoder, path)
        for batch in batches:
            tokens, whole, rest = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                ids = words.ids(text.as_py()) + last
                full = len(ids) // (4 * window)
                tokens.append(len(ids) // 4)
                whole.append([zlib.crc32(ids[i * 4 * window : (i + 1) * 4 * window]) for i in range(full)])
                rest.append(ids[full * 4 * window :])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(tokens, pa.int64()),
                    pa.array(whole, pa.list_(pa.int64())),
                    pa.array(rest, pa.binary()),
                ],
                names=["doc_id", "doc_tokens", "whole", "rest"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, doc_tokens long, whole array<long>, rest binary")


def combinations(units: int = UNITS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of 1 to ``depth`` lengths that sum to ``units``, largest length first."""

    def fill(left: int, most: int, slots: int) -> Iterator[tuple[int, ...]]:
        if not left:
            yield ()
        elif slots:
            for length in range(min(left, most), (left - 1) // slots, -1):
                for others in fill(left - length, length, slots - 1):
                    yield (length, *others)

    return list(fill(units, units, depth))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(20 * len(b)):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        if not len(gain) or gain.max() <= tolerance:
            break
        active[int(gain.argmax())] = True
        while True:
            own = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, own], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[own] = solved
                break
            low = solved <= 0
            step = np.min(x[own][low] / np.maximum(x[own][low] - solved[low], 1e-300))
            x[own] += step * (solved - x[own])
            x[own[low & (x[own] <= tolerance)]] = 0
            active[x <= 0] = False
            if not active.any():
                break
    return x


@dataclass
class Plan:
    """Places for remainders: for each length in units, runs of ranks and where they go."""

    #: by length: rank at which each run starts, combination, slot, first sequence of the combination
    runs: list[np.ndarray]
    sequences: int

    def place(self, unit: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence (-1: residual) and slot."""
        sequence, slot = np.full(len(unit), -1, np.int64), np.zeros(len(unit), np.int64)
        for u in np.unique(unit):
            runs = self.runs[u]
            own = np.flatnonzero(unit == u)
            if not len(runs):
                continue
            at = np.searchsorted(runs[:, 0], rank[own], "right") - 1
            inside = rank[own] - runs[at, 0] < runs[at, 1]
            own, at = own[inside], at[inside]
            sequence[own] = runs[at, 3] + rank[own] - runs[at, 0]
            slot[own] = runs[at, 2]
        return sequence, slot


def solve(histogram: dict[int, int], units: int = UNITS, depth: int = DEPTH, used: float = USED) -> Plan:
    """Repeat counts of the combinations for a histogram of lengths in units."""
    chosen = combinations(units, depth)
    a = np.zeros((units, len(chosen)))
    for j, lengths in enumerate(chosen):
        for length in lengths:
            a[length - 1, j] += 1
    have = np.array([histogram.get(u, 0) for u in range(1, units + 1)], np.float64)
    repeats = np.floor(nonnegative_least_squares(a, have) * used).astype(np.int64)
    left = have.astype(np.int64)
    runs: list[list] = [[] for _ in range(units + 1)]
    sequences = 0
    for j in np.flatnonzero(repeats):
        # the fit may ask for more of a length than there is
        count = int(min(repeats[j], *(left[u - 1] // chosen[j].count(u) for u in chosen[j])))
        if count < 1:
            continue
        for slot, u in enumerate(chosen[j]):
            runs[u].append((int(have[u - 1] - left[u - 1]), count, slot, sequences))
            left[u - 1] -= count
        sequences += count
    return Plan([np.array(r, np.int64).reshape(-1, 4) for r in runs], sequences)


def _ranked(tokens: DataFrame, groups: int) -> DataFrame:
    """Adds ``unit``, ``salt`` and ``rank`` (from 0, among remainders of the same length).

    Ranks are counted within salted groups and shifted by the groups before, so
    that a length that most documents share is spread over many tasks.
    """
    unit = F.ceil(F.octet_length("rest") / (4 * (WINDOW // UNITS))).cast("int")
    salted = tokens.withColumn("unit", unit).withColumn("salt", F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(groups)))
    before = Window.partitionBy("unit").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        salted.groupBy("unit", "salt")
        .count()
        .select("unit", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    )
    own = Window.partitionBy("unit", "salt").orderBy("doc_id", "doc_tokens", F.crc32("rest"))
    ranked = salted.withColumn("number", F.row_number().over(own) - 1)
    return ranked.join(shift, ["unit", "salt"]).withColumn("rank", F.col("number") + F.col("shift"))


def _pour(window: int, base: int, groups: int):
    """Fill the gaps of a group's sequences with its residual, then new sequences."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["kind", "sequence_id", "doc_id", "doc_tokens"], kind="stable")
        gaps, rest = rows[rows.kind == 0], rows[rows.kind == 1]
        places = [(int(s), window - int(n), int(n)) for s, n in zip(gaps.sequence_id, gaps.filled, strict=True)]
        tokens = int(sum(len(r) for r in rest.rest) // 4)
        room = sum(size for _, size, _ in places)
        left, number = max(0, tokens - room), 0
        while left:
            # the last tokens end in sequences whose lengths are powers of two
            size = window if left >= window else 1 << (left.bit_length() - 1)
            places.append((base + 3 * (int(rows.group.iloc[0]) + groups * number), size, 0))
            left, number = left - size, number + 1
        out, at, used = [], 0, 0
        for row in rest.itertuples():
            start = row.doc_tokens - len(row.rest) // 4
            cut, size = 0, len(row.rest) // 4
            while cut < size:
                sequence, room, filled = places[at]
                take = min(size - cut, room - used)
                if take:
                    piece = row.rest[4 * cut : 4 * (cut + take)]
                    out.append((row.doc_id, start + cut, take, zlib.crc32(piece), row.doc_tokens, sequence, filled + used))
                cut, used = cut + take, used + take
                if used == room:
                    at, used = at + 1, 0
        return pd.DataFrame(out, columns=PIECES).astype({c: "int64" for c in PIECES[1:]}).astype({"doc_id": "Int64"})

    return run


PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{c} long" for c in PIECES)


def pack(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each id of a document, its end id included, lies in exactly one piece. A null
    or empty text is the end id alone; an empty table gives no rows; rows that
    repeat are packed as often as they occur. Sequences hold 4096 ids or, at the
    end of a group, a power of two; only gaps that no residual is left to fill stay open.
    """
    spark = docs.sparkSession
    tokens = materialise(tokenise(docs, path, end), "tokens")
    whole = F.size("whole")
    groups = max(1, -(-tokens.count() // GROUP))
    unit = F.ceil(F.octet_length("rest") / (4 * (WINDOW // UNITS))).cast("int")
    # at most UNITS rows, whatever the data
    histogram = {r.unit: r["count"] for r in tokens.filter(F.octet_length("rest") > 0).groupBy(unit.alias("unit")).count().collect()}
    plan = spark.sparkContext.broadcast(solve(histogram))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sequence, slot = plan.value.place(
                batch.column(names.index("unit")).to_numpy(), batch.column(names.index("rank")).to_numpy()
            )
            rest = batch.column(names.index("rest"))
            taken = pa.array(sequence >= 0)
            sizes = pa.compute.divide(pa.compute.binary_length(rest), 4).cast(pa.int64())
            crc = pa.array([zlib.crc32(r.as_py()) for r in rest], pa.int64())
            kept = pa.compute.if_else(taken, pa.scalar(None, pa.binary()), rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, crc, pa.array(sequence), pa.array(slot), kept],
                names=["doc_id", "doc_tokens", "size", "crc", "sequence", "slot", "rest"],
            )

    # whole windows: numbered within a salted group, the group in the low part
    salt = F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(groups))
    long = tokens.filter(whole > 0).select("doc_id", "doc_tokens", "whole", salt.alias("salt"))
    earlier = Window.partitionBy("salt").orderBy("doc_id", "doc_tokens", F.xxhash64("whole"))
    windows = (
        long.withColumn("before", F.sum(whole).over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - whole)
        .select("doc_id", "doc_tokens", "salt", "before", F.posexplode("whole").alias("i", "crc"))
        .select(
            "doc_id",
            (F.col("i") * WINDOW).cast("long").alias("start"),
            F.lit(WINDOW).cast("long").alias("length"),
            F.col("crc").alias("ids_crc32"),
            "doc_tokens",
            (3 * (F.col("salt") + groups * (F.col("before") + F.col("i")))).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    ranked = _ranked(tokens.filter(F.octet_length("rest") > 0).select("doc_id", "doc_tokens", "rest"), groups)
    placed = materialise(
        ranked.select("doc_id", "doc_tokens", "rest", "unit", "rank").mapInArrow(
            place, "doc_id long, doc_tokens long, size long, crc long, sequence long, slot long, rest binary"
        ),
        "placed",
    )
    inside = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    combined = (
        placed.filter("sequence >= 0")
        .select("doc_id", "doc_tokens", "size", "crc", "sequence", "slot")
        .withColumn("filled", F.sum("size").over(inside))
        .select(
            "doc_id",
            (F.col("doc_tokens") - F.col("size")).alias("start"),
            F.col("size").alias("length"),
            F.col("crc").alias("ids_crc32"),
            "doc_tokens",
            (3 * F.col("sequence") + 1).alias("sequence_id"),
            (F.col("filled") - F.col("size")).alias("offset"),
        )
    )
    gaps = (
        placed.filter("sequence >= 0")
        .groupBy((3 * F.col("sequence") + 1).alias("sequence_id"))
        .agg(F.sum("size").alias("filled"))
        .filter(F.col("filled") < WINDOW)
        .select(
            F.lit(0).alias("kind"),
            F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("group"),
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(0).cast("long").alias("doc_tokens"),
            F.lit(None).cast("binary").alias("rest"),
            "sequence_id",
            "filled",
        )
    )
    residual = placed.filter("sequence < 0").select(
        F.lit(1).alias("kind"),
        F.pmod(F.xxhash64("doc_id", "doc_tokens", F.lit(1)), F.lit(groups)).alias("group"),
        "doc_id",
        "doc_tokens",
        "rest",
        F.lit(-1).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("filled"),
    )
    poured = gaps.union(residual).groupBy("group").applyInPandas(_pour(WINDOW, 2, groups), SCHEMA)
    return windows.union(combined).union(poured)
