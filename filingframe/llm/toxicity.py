"""Toxicity by noisy-channel restoration of obfuscated words.

Every chunk of a text is a lattice of what may have been meant: a letter stands
for itself, a digit or symbol for the letters it imitates or for nothing, a run
of one letter for one or two of it, a sign of any script for nothing, and a chunk of runs alone also
for its letters written as often less each. Single characters with white space between
them are one lattice, in which every gap may or may not end a word. A character
language model, counted over all documents, and the costs of the channel choose
the path (Viterbi, over all states there are). The score of a text joins the learnt
probabilities of its distinct restored words.

A chunk stands for itself where its lattice has no other path (letters without a run),
where it holds a letter beyond a-z without its accents, which the model does not know,
where it is a number, and where fewer than three letters could be meant.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingframe.llm.common import held_out, remembered, short_batches, texts

THRESHOLD = 0.3
#: Bound of what is learnt from: labelled documents (chosen by hash).
SAMPLE_DOCS = 20_000
#: A word may count where the lower bound of its toxic share (at Z) reaches LOWEST in MIN_DOCS documents.
MIN_DOCS, LOWEST, Z = 4, 0.3, 2.0
#: Penalty on squared weights, and rounds of the fit. What copies of one text share gets no
#: weight beside the words that explain its label already.
PENALTY, ROUNDS = 0.3, 400
#: Letters of the stems that inflected forms share.
STEMS = (4, 5)
#: Chunks remembered by a task.
REMEMBERED = 500_000
#: Symbols of the language model: the word boundary and a-z.
SYMBOLS, ORDER = 27, 4

# Letters that digits and symbols imitate.
IMITATED = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
#: Costs (negative logarithms) of the channel: also of letters that are all written alike often, and of a word's end in a gap.
IMITATE, DROP_DIGIT, DROP_SYMBOL, COLLAPSE, STRETCH, GAP = 0.7, 5.0, 1.2, 2.5, 2.5, 0.0

_EDGE = re.compile(r"^[^\w$@]+|(?:([\W_])\1\1+)+$|[^\w$@]+$")
_RUN = re.compile(r"(.)\1")
_GAP = re.compile(r"\s|(?<!^)_(?!$)")
_SPACED = re.compile(r"(?<!\S)[^\s_](?:[\s_]+[^\s_]){2,}(?!\S)")


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.lower())
    return "".join(c for c in text if not unicodedata.combining(c))


_LETTERS = np.zeros(256, np.int32)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(1, SYMBOLS)


def _contexts(text: str) -> np.ndarray:
    """Codes of each character after the three before it; nothing reaches over a boundary."""
    code = _LETTERS[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
    code = np.concatenate([np.zeros(3, np.int32), code, np.zeros(1, np.int32)])
    c, one, two, three = code[3:], code[2:-1], code[1:-2], code[:-3]
    two = np.where(one == 0, 0, two)
    three = np.where(two == 0, 0, three)
    joined = ((three * SYMBOLS + two) * SYMBOLS + one) * SYMBOLS + c
    return joined[(c != 0) | (one != 0)]


def character_counts(docs: DataFrame) -> DataFrame:
    """``code, n`` over all documents: at most SYMBOLS ** ORDER rows."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**ORDER, np.int64)
        for batch in batches:
            joined = " ".join(batch.column(0).to_pylist()).lower()
            if not joined.isascii():
                joined = unicodedata.normalize("NFKD", joined)
                joined = joined.encode("ascii", "ignore").decode()
            counts += np.bincount(_contexts(joined), minlength=len(counts))
        code = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(counts[code])], names=["code", "n"])

    return texts(docs).select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_model(codes: np.ndarray, counts: np.ndarray, strength: float = 5.0) -> np.ndarray:
    """Negative log probabilities, indexed by three characters of context and the next one.

    Each order is smoothed by the one below. No counts give a uniform model.
    """
    full = np.zeros(SYMBOLS**ORDER)
    full[codes] = counts
    full = full.reshape([SYMBOLS] * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER):
        seen = full.sum(axis=tuple(range(ORDER - 1 - order)))
        p = (seen + strength * p) / (seen.sum(-1, keepdims=True) + strength)
    return -np.log(p).astype(np.float32)


def _options(run: str, n: int) -> list[tuple[str, float]]:
    """What ``n`` times the character ``run`` may have meant, with costs."""
    if "a" <= run <= "z":
        if n == 1:
            return [(run, 0.0)]
        if n == 2:
            return [(run * 2, 0.0), (run, COLLAPSE)]
        return [(run, 0.0), (run * 2, 0.5)]
    meant = IMITATED.get(run, "")
    drop = DROP_DIGIT if run.isdigit() else DROP_SYMBOL
    options = [("", drop * min(n, 3))]
    for letter in meant:
        options.append((letter, IMITATE))
        if n > 1:
            options.append((letter * 2, IMITATE * 2))
    return options


@dataclass(eq=False)
class Model:
    characters: np.ndarray
    words: dict[str, float]
    bias: float


Steps = list[list[tuple[str, float]]]


def cheapest(steps: Steps, costs: list[float]) -> tuple[float, str]:
    """Cost and text of the likeliest path through a lattice; a blank ends a word.

    Viterbi over the last three letters. Of equal paths the one whose options come first stays.
    """
    states = SYMBOLS ** (ORDER - 1)
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in steps:
        ahead: dict[int, tuple[float, tuple | None]] = {}
        if len(options) == 1 and options[0][0].isalpha() and len(options[0][0]) == 1:
            # a letter that stands for itself
            meant, extra = options[0]
            code = ord(meant) - 96
            for state, (cost, way) in paths.items():
                at = state * SYMBOLS + code
                total = cost + extra + costs[at]
                s = at % states
                if s not in ahead or total < ahead[s][0]:
                    ahead[s] = (total, (way, meant))
            paths = ahead
            continue
        for state, (cost, way) in paths.items():
            for meant, extra in options:
                s, total = state, cost + extra
                for letter in meant:
                    if letter == " ":
                        # nothing reaches over the end of a word, and an empty word costs nothing
                        total += costs[s * SYMBOLS] if s else 0.0
                        s = 0
                    else:
                        at = s * SYMBOLS + ord(letter) - 96
                        total += costs[at]
                        s = at % states
                if s not in ahead or total < ahead[s][0]:
                    ahead[s] = (total, (way, meant) if meant else way)
        paths = ahead
    cost, way = min(((c + (costs[s * SYMBOLS] if s else 0.0), w) for s, (c, w) in paths.items()), key=lambda x: x[0])
    parts = []
    while way:
        way, meant = way
        parts.append(meant)
    return cost, "".join(reversed(parts))


def lattices(chunk: str) -> list[tuple[float, Steps]]:
    """What a folded chunk may be: its runs as they are, and, if no letter of it stands alone, fewer of each."""
    runs = [(c, len(list(same))) for c, same in itertools.groupby(chunk)]
    found = [(0.0, [_options(c, n) for c, n in runs])]
    least = min((n for c, n in runs if c.isalnum()), default=1)
    if least > 1:
        found.append((STRETCH, [_options(c, max(1, n // least)) for c, n in runs]))
    return found


def decode(chunk: str, costs: list[float]) -> str:
    """The likeliest word behind a folded chunk."""
    best = [(extra + cost, word) for extra, steps in lattices(chunk) for cost, word in [cheapest(steps, costs)]]
    return min(best, key=lambda x: x[0])[1]


def restore(chunk: str, costs: list[float]) -> str:
    """The word meant by a chunk: itself where the lattice has a single path."""
    word = _EDGE.sub("", _EDGE.sub("", fold(chunk)))
    if not word or word.isalpha() and not _RUN.search(word):
        return word
    if not word.isascii() and any(c.isalpha() and not "a" <= c <= "z" for c in word):
        return word
    letters = sum("a" <= c <= "z" for c in word)
    imitations = sum(c in IMITATED for c in word)
    if letters + imitations < 3 or letters == 0 and word.isdigit():
        return word
    return decode(word, costs)


def spaced(text: str) -> list[str]:
    """Runs of single characters with white space or underscores between them."""
    return [m.group() for m in _SPACED.finditer(text)]


def spelt_steps(run: str) -> Steps:
    """The lattice of a run of single characters: each gap joins them, or ends a word."""
    characters = fold("".join(re.split(r"[\s_]+", run)))
    steps: Steps = []
    for character in characters:
        if steps:
            steps.append([("", 0.0), (" ", GAP)])
        known = "a" <= character <= "z" or character in IMITATED
        steps.append(_options(character, 1) if known else [(" ", 0.0)])
    return steps


def restore_spaced(run: str, costs: list[float]) -> list[str]:
    """The words meant by a run of single characters."""
    return cheapest(spelt_steps(run), costs)[1].split()


def features(word: str) -> list[str]:
    """A restored word, and the stems that its inflected forms share."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)] if word else []


def restored(part: str, costs: list[float]) -> list[str]:
    """The words meant by a chunk, or by a run of single characters, which alone holds gaps."""
    if len(part) > 1 and _GAP.search(part):
        return restore_spaced(part, costs)
    word = restore(part, costs)
    return [word] if word else []


def parts(text: str) -> set[str]:
    """Distinct chunks and runs of single characters of a whole text."""
    return {*text.split(), *spaced(text)}


def restored_words(text: str, costs: list[float], known: dict[str, str]) -> set[str]:
    """Distinct restored words of a whole text."""
    if len(known) > REMEMBERED:
        known.clear()
    found: set[str] = set()
    for part in parts(text):
        own = known.get(part)
        if own is None:
            known[part] = own = " ".join(restored(part, costs))
        found.update(own.split())
    return found


def fit_weights(found: list[list[int]], toxic: np.ndarray, words: int) -> tuple[np.ndarray, float]:
    """Weights that are not negative, and bias, of a logistic model over sets of words.

    Each step is bounded by the curvature of its own weight, so frequent words settle first.
    """
    row = np.repeat(np.arange(len(found)), list(map(len, found)))
    column = np.fromiter((w for own in found for w in own), np.int64, len(row))
    weights, bias = np.zeros(words), -4.0
    support = np.bincount(column, minlength=words)
    crowd = max(map(len, found), default=1)
    for _ in range(ROUNDS if found else 0):
        logit = bias + np.bincount(row, weights[column], minlength=len(found))
        error = 1 / (1 + np.exp(-logit)) - toxic
        gradient = np.bincount(column, error[row], minlength=words) + PENALTY * weights
        step = 4 / (np.sqrt(support * max(1, support.max(initial=1))) * min(crowd, 4) + PENALTY)
        weights = np.maximum(0, weights - step * gradient)
        bias = min(-2.0, bias - 0.5 * float(error.mean()))
    return weights, bias


def _sample(labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labelled documents outside the held-out fold, chosen by hash."""
    known = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, 0.98 * size / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) / 1_000_000
    return known.filter(draw < share).limit(size)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Count characters over all documents and learn words from a bounded labelled sample.

    Labels that repeat count once (the largest), null labels not at all, and each text
    counts once, however many copies there are. Without labels, or without
    documents, no word is learnt, and nothing scores as toxic.
    """
    spark = docs.sparkSession
    counts = character_counts(docs).toArrow()
    characters = character_model(counts.column(0).to_numpy(), counts.column(1).to_numpy())
    shared = spark.sparkContext.broadcast(characters)  # SYMBOLS ** ORDER numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        costs = shared.value.ravel().tolist()
        seen = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            found = list(seen[0].keys() | seen[1].keys())
            rows = [pa.array(found, pa.string()), *(pa.array([s[w] for w in found], pa.int64()) for s in seen)]
            for s in seen:
                s.clear()
            return pa.RecordBatch.from_arrays(rows, names=["word", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words_found = restored_words(text, costs, known)
                seen[toxic].update({f for word in words_found for f in features(word)})
            if len(seen[0]) > REMEMBERED:
                yield flush()
        yield flush()

    # at most `sample` rows of two numbers each: sampled ids, then their distinct texts by hash, since
    # copies of one text are no further witness of its words, and an id may repeat with other texts
    chosen = F.broadcast(_sample(labels, sample).select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")))
    hashed = texts(docs).withColumn("h", F.xxhash64("text"))
    keys = hashed.select("doc_id", "h").join(chosen, "doc_id").select("h", "toxic").distinct()
    keys = F.broadcast(keys.orderBy("h", "toxic").limit(sample))
    once = hashed.join(keys, "h").groupBy("h", "toxic").agg(F.first("text").alias("text")).select("text", "toxic")
    n, toxic = F.col("clean") + F.col("toxic"), F.col("toxic")
    share = toxic / n
    margin = Z * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))
    lower = (share + Z * Z / (2 * n) - margin) / (1 + Z * Z / n)
    candidates = (
        once.mapInArrow(run, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((toxic >= MIN_DOCS) & (lower >= LOWEST))
        .collect()
    )
    number = {word: i for i, word in enumerate(sorted(r.word for r in candidates))}
    numbers = spark.sparkContext.broadcast(number)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        costs = shared.value.ravel().tolist()
        for batch in batches:
            own = []
            for text in batch.column(0).to_pylist():
                found = {f for w in restored_words(text, costs, known) for f in features(w)}
                own.append(sorted(numbers.value[f] for f in found & numbers.value.keys()))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.int32()))], names=["toxic", "found"])

    # sorted, so that the order in which rows arrive does not count
    learnt = sorted((r.toxic, r.found) for r in once.mapInArrow(sets, "toxic int, found array<int>").collect())
    weights, bias = fit_weights([f for _, f in learnt], np.array([t for t, _ in learnt], np.float64), len(number))
    return Model(characters, {w: float(weights[i]) for w, i in number.items() if weights[i] > 0.01}, bias)


class Scorer:
    """Scores whole texts, remembering what chunks restore to."""

    def __init__(self, model: Model):
        self.model = model
        self.costs = model.characters.ravel().tolist()
        #: learnt features of a chunk, joined by spaces
        self.known: dict[str, str] = {}

    def evidence(self, text: str) -> list[str]:
        known, words = self.known, self.model.words
        if len(known) > REMEMBERED:
            known.clear()
        found: set[str] = set()
        for part in parts(text):
            own = known.get(part)
            if own is None:
                meant = restored(part, self.costs)
                known[part] = own = " ".join(f for word in meant for f in features(word) if f in words)
            if own:
                found.update(own.split())
        return sorted(found)

    def score(self, evidence: list[str]) -> float:
        return 1 / (1 + math.exp(-self.model.bias - sum(self.model.words[w] for w in evidence)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, evidence``: probability from 0 to 1, and the restored words behind it.

    Null and empty texts have the score of a text without any learnt word. Repeated rows
    give repeated results; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # SYMBOLS ** ORDER numbers and the words learnt from SAMPLE_DOCS documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(Scorer, shared.value)
        for batch in batches:
            evidence = [scorer.evidence(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(scorer.score, evidence), pa.float64()),
                    pa.array(evidence, pa.list_(pa.string())),
                ],
                names=["doc_id", "score", "evidence"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, score double, evidence array<string>")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns stay as they are."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(Scorer, shared.value)
        for batch in batches:
            clean = [scorer.score(scorer.evidence(t or "")) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
