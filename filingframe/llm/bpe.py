"""Byte-level BPE: encoding with a segment tree over byte positions, and decoding.

The leaves of the tree stand for byte positions; a leaf holds the rank of the
pair that starts there, joined with the position, so the root is the leftmost
pair of least rank. A node has sixteen children. A merge changes three leaves at most: its own pair, the
pair of the live neighbour before it, and the pair that it swallowed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from filingframe.llm.common import short_batches, texts

#: Children of a node of the segment tree.
WIDE = 16
#: Chunks whose ids one task remembers, and the longest chunk it remembers.
REMEMBERED, LONGEST = 500_000, 64
#: White space as the split patterns of the vocabularies mean it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of the split pattern.

    Empty input gives no ids; a piece that is itself in the vocabulary is one id.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    get = ranks.get
    shift = n.bit_length()
    dead = len(ranks) << shift  # above every live key
    leaves = [dead if (rank := get(piece[i : i + 2])) is None else rank << shift | i for i in range(n - 1)]
    levels = [leaves]
    while len(levels[-1]) > WIDE:
        levels.append([min(levels[-1][i : i + WIDE]) for i in range(0, len(levels[-1]), WIDE)])
    root, above = levels[-1], levels[1:]
    after = list(range(1, n + 1))  # start of the next live part
    before = list(range(-1, n - 1))
    position = (1 << shift) - 1
    while leaves and (least := min(root)) < dead:
        start = least & position
        gone = after[start]
        end = after[start] = after[gone]
        if end < n:
            before[end] = start
            rank = get(piece[start : after[end]])
            leaves[start] = dead if rank is None else rank << shift | start
            leaves[gone] = dead
        else:
            leaves[start] = dead
        prior = before[start]
        if prior >= 0:
            rank = get(piece[prior:end])
            leaves[prior] = dead if rank is None else rank << shift | prior
        if above:
            touched, below = {start, min(gone, n - 2), max(prior, 0)}, leaves
            for level in above:
                touched = {i // WIDE for i in touched}
                for i in touched:
                    level[i] = min(below[i * WIDE : i * WIDE + WIDE])
                below = level
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Codec:
    """Encodes whole texts, remembering the chunks it has met.

    A chunk is a run without white space and the space before it; matches of the
    split pattern never cross the end of a chunk, so chunks encode apart.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        self.ranks, self.remembered = ranks, remembered
        count = max(ranks.values(), default=-1) + 1
        self.parts = [b""] * count
        for part, rank in ranks.items():
            self.parts[rank] = part
        self.decimals = list(map(str, range(count)))
        self.split = regex.compile(pattern).findall
        self.chunks = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        # packed ids by chunk and by piece: what was met lately, and before that
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        out, pieces = [], self.pieces
        for piece in self.split(chunk):
            packed = pieces.get(piece)
            if packed is None:
                packed = array("I", encode_piece(piece.encode(), self.ranks)).tobytes()
                if len(piece) <= LONGEST:
                    pieces[piece] = packed
            out.append(packed)
        return b"".join(out)

    def ids(self, text: str) -> list[int]:
        chunks = self.chunks(text)
        if len(self.recent) > self.remembered:
            self.older, self.recent = self.recent, {}
        if len(self.pieces) > self.remembered:
            self.pieces = {}
        recent, older = self.recent, self.older
        long: dict[str, bytes] = {}
        for chunk in set(chunks):
            if chunk not in recent:
                packed = older.get(chunk) or self._chunk(chunk)
                # a long chunk is kept for this text only
                (recent if len(chunk) <= LONGEST else long)[chunk] = packed
        found = [recent.get(c) or long[c] for c in chunks] if long else map(recent.__getitem__, chunks)
        return array("I", b"".join(found)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids))


@cache
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec for all tasks that a Python worker runs."""
    return Codec(read_ranks(ranks_path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded``: ids in order, and the bytes they stand for.

    Null and empty texts give an empty array. Repeated rows give repeated results.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        for batch in batches:
            ids = [bpe.ids(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(map(len, ids), pa.int64()),
                    pa.array(map(bpe.decode, ids), pa.binary()),
                ],
                names=["doc_id", "ids", "n_tokens", "decoded"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the same encoding.

    The digests are taken beside the ids, so that the ids need not travel. The
    digest of no ids is that of the empty string.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        for batch in batches:
            counts, written, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.ids(text)
                counts.append(len(ids))
                decimal = ",".join(map(bpe.decimals.__getitem__, ids))
                written.append(hashlib.sha256(decimal.encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
