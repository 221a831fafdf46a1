"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment (a run between ASCII white space, cut
at ``SEGMENT`` bytes) forwards and backwards, and gives every byte position a
distribution over the languages. A document's distribution is the mean over all
its positions. Since the state starts anew with each segment, the sums of equal
segments are equal and are computed once per task.

Training is backpropagation through time in numpy on a bounded sample
(``SAMPLE_DOCS`` distinct texts and ``SAMPLE_WORDS`` distinct segments of each language).
Texts are lowered and cut by one function for training and prediction.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingframe.llm.common import held_out, remembered, short_batches
from filingframe.operators.quantiles import exact_quantiles
from filingframe.session import drop, materialise

UNDETERMINED = "und"
#: Longest run of bytes that one pass of the network reads.
SEGMENT = 32
#: Bounds of the training sample: distinct texts and distinct segments of each language,
#: and languages (those with most texts, far more than a corpus is labelled with).
SAMPLE_DOCS, SAMPLE_WORDS, LANGUAGES = 400, 6_000, 200
HIDDEN, EPOCHS, BATCH, RATE = 16, 10, 256, 0.01
#: Quantile of the scores of learned documents that the least score of a determined text keeps under.
LOW = 0.01
#: Segments whose sums one task remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Segments that pass through the network together.
BLOCK = 4096


@dataclass
class Direction:
    """One reading direction: byte table, recurrent weights and their bias."""

    x: np.ndarray  # 256 x 3H: update, reset, candidate
    u: np.ndarray  # H x 3H
    b: np.ndarray  # 3H, added to the recurrent part of the candidate only through u


@dataclass(eq=False)
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    v: np.ndarray  # 2H x C
    c: np.ndarray  # C

    def parts(self) -> list[np.ndarray]:
        f, b = self.forward, self.backward
        return [f.x, f.u, f.b, b.x, b.u, b.b, self.v, self.c]


def new_network(langs: list[str], hidden: int = HIDDEN, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)

    def weights(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    def direction() -> Direction:
        return Direction(weights(256, 3 * hidden), weights(hidden, 3 * hidden) * 0.7, np.zeros(3 * hidden, np.float32))

    return Network(langs, direction(), direction(), weights(2 * hidden, len(langs)), np.zeros(len(langs), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(d: Direction, steps: list[np.ndarray], keep: list | None = None) -> list[np.ndarray]:
    """States after each step; ``steps`` has one byte column a step."""
    hidden = d.u.shape[0]
    h = np.zeros((len(steps[0]), hidden), np.float32)
    states = []
    for column in steps:
        x = d.x[column] + d.b
        hu = h @ d.u
        gates = _sigmoid(x[:, : 2 * hidden] + hu[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(x[:, 2 * hidden :] + r * hu[:, 2 * hidden :])
        if keep is not None:
            keep.append((column, h, z, r, n, hu[:, 2 * hidden :]))
        h = n + z * (h - n)
        states.append(h)
    return states


def _back(d: Direction, kept: list, grads: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of the byte table, weights and bias."""
    gx, gu, gb = np.zeros_like(d.x), np.zeros_like(d.u), np.zeros_like(d.b)
    dh = np.zeros_like(grads[0])
    for (column, h, z, r, n, hn), own in zip(reversed(kept), reversed(grads), strict=True):
        dh = dh + own
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        at_x = np.concatenate([dz, dr, dn], axis=1)
        at_u = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(gx, column, at_x)
        gb += at_x.sum(0)
        gu += h.T @ at_u
        dh = dh * z + at_u @ d.u.T
    return gx, gu, gb


def positions(net: Network, rows: np.ndarray) -> np.ndarray:
    """Distribution of every position of segments of one length: rows x length x C."""
    steps = list(rows.T)
    ahead = _read(net.forward, steps)
    behind = _read(net.backward, steps[::-1])[::-1]
    hidden = net.forward.u.shape[0]
    logits = np.stack(
        [f @ net.v[:hidden] + b @ net.v[hidden:] + net.c for f, b in zip(ahead, behind, strict=True)], axis=1
    )
    e = np.exp(logits - logits.max(2, keepdims=True))
    return e / e.sum(2, keepdims=True)


def _gradients(net: Network, rows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    steps, hidden = list(rows.T), net.forward.u.shape[0]
    kept_f: list = []
    kept_b: list = []
    ahead = _read(net.forward, steps, kept_f)
    behind = _read(net.backward, steps[::-1], kept_b)[::-1]
    gv, gc, grads_f, grads_b = np.zeros_like(net.v), np.zeros_like(net.c), [], []
    scale = (weight / (weight.sum() * len(steps)))[:, None].astype(np.float32)
    for f, b in zip(ahead, behind, strict=True):
        logits = f @ net.v[:hidden] + b @ net.v[hidden:] + net.c
        e = np.exp(logits - logits.max(1, keepdims=True))
        delta = e / e.sum(1, keepdims=True)
        delta[np.arange(len(label)), label] -= 1
        delta *= scale
        gv += np.concatenate([f, b], axis=1).T @ delta
        gc += delta.sum(0)
        grads_f.append(delta @ net.v[:hidden].T)
        grads_b.append(delta @ net.v[hidden:].T)
    return [*_back(net.forward, kept_f, grads_f), *_back(net.backward, kept_b, grads_b[::-1]), gv, gc]


def train(examples: list[tuple[str, bytes, float]], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit the network on (language, segment, weight); the result depends only on the arguments."""
    langs = sorted({lang for lang, _, _ in examples})
    net = new_network(langs, seed=seed)
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(langs)}
    total = dict.fromkeys(langs, 0.0)
    for lang, _, w in examples:
        total[lang] += w
    by_length: dict[int, list] = {}
    for lang, word, w in sorted(examples):
        by_length.setdefault(len(word), []).append((word, number[lang], w / total[lang]))
    groups = {}
    for n, own in by_length.items():
        rows = np.frombuffer(b"".join(word for word, _, _ in own), np.uint8).reshape(len(own), n)
        groups[n] = rows, np.array([y for _, y, _ in own]), np.array([w for _, _, w in own])
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step = 0
    for epoch in range(epochs):
        batches = []
        for n, (_, y, _) in groups.items():
            order = rng.permutation(len(y))
            batches += [(n, order[i : i + BATCH]) for i in range(0, len(y), BATCH)]
        mean = sum(w.sum() * n for n, (_, _, w) in groups.items()) / max(1, len(batches))
        for i in rng.permutation(len(batches)):
            n, own = batches[i]
            rows, y, w = groups[n]
            step += 1
            heft = min(3.0, w[own].sum() * n / mean)
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, (m, s) in zip(net.parts(), _gradients(net, rows[own], y[own], w[own]), moments, strict=True):
                g = g * heft
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= (rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return net


def lowered(text: bytes) -> bytes:
    """UTF-8 text in lower case, beyond ASCII too."""
    return text.lower() if text.isascii() else text.decode().lower().encode()


def pieces(word: bytes) -> list[bytes]:
    """A run between white space, cut into what one pass of the network reads."""
    return [word[at : at + SEGMENT] for at in range(0, len(word), SEGMENT)]


def learned_documents(docs: DataFrame, docs_per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, text, lang`` of a bounded sample of labelled documents outside the held-out fold.

    Texts are drawn by their hash, which stands as their ``doc_id``, and each text counts
    once a language, however often it is repeated.
    """
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select(F.xxhash64("text").alias("doc_id"), "text", "lang")
    distinct = labelled.select("lang", "doc_id").distinct()
    langs = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    draw = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(10)), "doc_id")
    chosen = (
        distinct.join(F.broadcast(langs), "lang")
        .withColumn("place", F.row_number().over(draw))
        .filter(F.col("place") <= docs_per_lang)
        .drop("place")
    )
    # at most LANGUAGES x docs_per_lang rows of two short values; copies are reduced before they are shuffled
    found = labelled.join(F.broadcast(chosen), ["lang", "doc_id"])
    return found.groupBy("doc_id", "lang").agg(F.first("text").alias("text")).select("doc_id", "text", "lang")


def training_segments(
    docs: DataFrame, docs_per_lang: int = SAMPLE_DOCS, words: int = SAMPLE_WORDS
) -> list[tuple[str, bytes, float]]:
    """Labelled segments of the documents that are learned from, the most frequent ones of each language.

    The weight is the square root of a segment's count in the sample.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, bytes]] = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((lang, piece) for word in lowered(text).split() for piece in pieces(word))
            rows = [(lang, piece, n) for (lang, piece), n in counts.items()]
            kinds = (pa.string(), pa.binary(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "piece", "n"])

    often = Window.partitionBy("lang").orderBy(F.desc("n"), "piece")
    rows = (
        learned_documents(docs, docs_per_lang)
        .select("lang", F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "lang string, piece binary, n long")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(often))
        .filter(F.col("place") <= words)
        .collect()
    )
    return sorted((r.lang, bytes(r.piece), float(np.sqrt(r.n))) for r in rows)


class Labeller(dict):
    """Sums of position distributions of segments, by segment: the row where they are kept.

    A segment that is not there yet gets a row when it is looked up; the network
    then reads all new segments of a batch of texts together.
    """

    def __init__(self, net: Network, remembered: int = REMEMBERED):
        super().__init__()
        self.net, self.remembered = net, remembered
        self.sums = np.zeros((1024, len(net.langs)), np.float32)
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self)
        self.fresh.append(word)
        return row

    def _learn(self) -> None:
        first = len(self) - len(self.fresh)
        if len(self) > len(self.sums):
            grown = np.zeros((2 * len(self), self.sums.shape[1]), np.float32)
            grown[:first] = self.sums[:first]
            self.sums = grown
        self.sums[first : len(self)] = 0
        by_length: dict[int, tuple[list[bytes], list[int]]] = {}
        for row, word in enumerate(self.fresh, first):
            for piece in pieces(word):
                block, rows = by_length.setdefault(len(piece), ([], []))
                block.append(piece)
                rows.append(row)
        for n, (words, rows) in by_length.items():
            for at in range(0, len(words), BLOCK):
                block = words[at : at + BLOCK]
                read = np.frombuffer(b"".join(block), np.uint8).reshape(len(block), n)
                np.add.at(self.sums, rows[at : at + BLOCK], positions(self.net, read).sum(1))
        self.fresh.clear()

    def distributions(self, texts: list[bytes | None]) -> np.ndarray:
        """Mean distribution over all positions of each text's segments; even where there is none."""
        if len(self) > self.remembered:
            self.clear()
        found = [np.array(list(map(self.__getitem__, lowered(t).split())), np.int64) if t else None for t in texts]
        self._learn()
        out = np.full((len(texts), len(self.net.langs)), 1 / len(self.net.langs))
        for i, rows in enumerate(found):
            if rows is not None and len(rows):
                total = self.sums[rows].sum(0, dtype=np.float64)
                out[i] = total / total.sum()
        return out


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document.

    Null text, text without a letter, and any text when nothing could be learned
    are ``und`` with score 0. Equal scores go to the language that sorts first.
    Repeated rows give repeated results; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(net)  # some 100 kB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, langs = remembered(Labeller, shared.value), shared.value.langs
        for batch in batches:
            values = batch.column(1).cast(pa.binary()).to_pylist()
            p = own.distributions(values)
            best = p.argmax(1)
            pred = [UNDETERMINED if t is None else langs[i] for t, i in zip(values, best, strict=True)]
            score = [0.0 if t is None else float(min(1.0, row.max())) for t, row in zip(values, p, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def least_score(docs: DataFrame, net: Network | None) -> float:
    """A score that texts in one language or two exceed, from all labelled documents outside the held-out fold.

    The scores of correctly labelled ones are taken, each text once a language: their LOW
    quantile, or half of their median, which a text in two languages has, where that is less. Both
    are exact. The limit lies halfway between it and an even share of the languages. With one or two
    languages a text in both has no more than an even share, and the limit is 0.
    """
    if net is None:
        return 0.0
    spark = docs.sparkSession
    short_batches(spark)
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, langs = remembered(Labeller, shared.value), shared.value.langs
        for batch in batches:
            p = own.distributions(batch.column(0).cast(pa.binary()).to_pylist())
            pred = pa.array([langs[i] for i in p.argmax(1)], pa.string())
            score = pa.array(np.minimum(p.max(1), 1.0), pa.float64())
            scored = pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2).cast(pa.string()), pred, score], names=["text", "lang", "pred", "score"]
            )
            yield scored

    rows = labelled.select("text", F.xxhash64("text").alias("hash"), "lang")
    scored = rows.mapInArrow(run, "text long, lang string, pred string, score double").where("lang = pred")
    own = materialise(scored.groupBy("lang", "text").agg(F.min("score").alias("score")), "scores")
    both = exact_quantiles(own.withColumn("of", F.lit("all")), ["of"], "score", [LOW, 0.5], few_groups=True).first()
    even = 1 / len(net.langs)
    usual = min(both["q0"], both["q1"] / 2) if both else 0.0
    drop(own)
    return float((usual + even) / 2) if usual > even else 0.0


def keep_determined(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """``docs`` without the rows that are ``und`` or whose score is under ``least``; columns stay as they are.

    Where nothing could be learned, texts with a letter stay.
    """
    letters = docs.filter(F.col("text").rlike(r"\p{L}"))
    if net is None:
        return letters
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = remembered(Labeller, shared.value)
        for batch in batches:
            p = own.distributions(batch.column(at).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array(p.max(1) >= least))

    return letters.mapInArrow(run, docs.schema)


def fit(docs: DataFrame) -> Network | None:
    """Train on the documents outside the held-out fold; None where no language is known."""
    examples = training_segments(docs)
    return train(examples) if examples else None
