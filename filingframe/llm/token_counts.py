"""Token counts under a unigram model, by dynamic programming over a trie.

Pre-tokens (runs without white space, with the word mark before them) are
inserted in a trie. A node holds the best forward score of the prefix that leads
to it and the number of tokens on that path; both are computed once, when the
node is made, so words that share a prefix share its scores. A terminal node's
count is the pre-token's count.

The vocabulary gives ranks, not probabilities; by Zipf's law the log probability
of rank r is taken as -log(r + SHIFT), up to a constant for each token.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from filingframe.llm.common import remembered, short_batches, texts

MARK = "▁"
SHIFT = 10
#: Constant of every token: log of the sum over a vocabulary of about 32,000 ranks.
TOKEN = -8.0
#: A character outside the vocabulary costs this for each of its UTF-8 bytes, which are tokens.
BYTE = -25.0
#: Trie nodes that a worker keeps before it starts anew.
NODES = 1_600_000


def read_pieces(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a vocabulary file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            pieces.setdefault(model.id_to_piece(i), TOKEN - math.log(len(pieces) + SHIFT))
    return pieces


class _Counts(dict):
    """Tokens by pre-token; one that is not there yet is inserted when it is looked up."""

    def __init__(self, insert: Callable[[str], int]):
        super().__init__()
        self.insert = insert

    def __missing__(self, chunk: str) -> int:
        found = self[chunk] = self.insert(MARK + chunk)
        return found


class Trie:
    """Best segmentation of every prefix inserted so far.

    Of equal scores the segmentation with fewer tokens counts, whichever piece ends it.
    """

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        #: pieces that end in a character are at most this long
        self.ends: dict[str, int] = {}
        for piece in pieces:
            self.ends[piece[-1]] = max(self.ends.get(piece[-1], 1), len(piece))
        self.clear()

    def clear(self) -> None:
        #: child by node and character
        self.children: dict[int, int] = {}
        self.score, self.tokens = array("d", [0.0]), array("i", [0])
        self.counts = _Counts(self.insert)

    def insert(self, word: str) -> int:
        """Add a pre-token; its number of tokens."""
        children, score, tokens, get = self.children, self.score, self.tokens, self.pieces.get
        node, path = 0, [0]
        for i, c in enumerate(word):
            edge = node << 21 | ord(c)
            child = children.get(edge)
            if child is None:
                end, size = i + 1, len(c.encode())
                best, least = score[node] + BYTE * size, tokens[node] + size
                for start in range(max(0, end - self.ends.get(c, 0)), end):
                    own = get(word[start:end])
                    if own is not None:
                        before = path[start]
                        own += score[before]
                        if own > best or own == best and tokens[before] + 1 < least:
                            best, least = own, tokens[before] + 1
                child = children[edge] = len(score)
                score.append(best)
                tokens.append(least)
            node = child
            path.append(node)
        return tokens[node]

    def count(self, text: str) -> tuple[int, int]:
        """Pre-tokens and tokens of a whole text."""
        chunks = text.split()
        if len(self.score) > NODES or len(self.counts) > NODES // 2:
            self.clear()
        return len(chunks), sum(map(self.counts.__getitem__, chunks))


def trie(path: str) -> Trie:
    return Trie(read_pieces(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every whole text.

    A pre-token is a run without white space (as Python's str.split sees it). Null
    and empty texts count nothing; repeated rows give repeated results.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = remembered(trie, path)
        for batch in batches:
            found = [own.count(t) for t in batch.column(1).to_pylist()]
            words, tokens = [n for n, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
