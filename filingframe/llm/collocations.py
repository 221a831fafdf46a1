"""Phrases of words that stand together, from counting quotient filters.

Texts become shards of word numbers. Words that are frequent enough in a language
get ids; an n-gram of ids is packed into one wide integer, which an invertible
permutation spreads evenly. Its leading bits are the quotient, whose runs are
written in unary, the others the remainder, which is kept in full, so a filter is
a compact sorted counter that loses nothing. Each shard writes its filters in
slices by the leading bits; a slice's filters of all shards are merged where they
meet, and the permutation is undone for the phrases that are left. No word count
or dictionary of the corpus is ever sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.llm.common import short_batches
from filingframe.operators.frame import row_numbers
from filingframe.session import materialise

MIN_COUNT = 30
MAX_WORDS = 4
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: Words of a shard, about; a longer text makes a longer shard.
SHARD_WORDS = 1 << 20
#: Languages of which a task holds open shards at once.
OPEN_LANGS = 256
#: Entries that a merged slice holds, about.
SLICE_ENTRIES = 1 << 21

_STOP = b"."
_TABLE = bytearray(range(256))
_TABLE[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
for _c in b".,;:!?\n\v\f\r":
    _TABLE[_c] = _STOP[0]
_TABLE[ord("\t")] = ord(" ")
_TABLE = bytes(_TABLE)

_SHARDS = pa.schema(
    [
        ("shard", pa.int64()),
        ("lang", pa.string()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("stream", pa.binary()),
    ]
)
_SHARD_COLUMNS = "shard long, lang string, words array<string>, counts array<long>, stream binary"
_W = [f"w{i}" for i in range(1, MAX_WORDS + 1)]
_U = np.uint64


# ------------------------------------------------------------------- shards


class _Numbers(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_TABLE).replace(_STOP, b" . ").split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, [*words, _STOP]), "<u4", len(words) + 1))
        self.size += len(words)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        stream = np.concatenate(self.parts)
        counts = np.bincount(stream, minlength=len(self.numbers))[1:]
        words = pa.array(list(self.numbers)[1:], pa.binary()).cast(pa.string())
        columns = [[number], [lang], [words.to_pylist()], [counts.tolist()], [stream.tobytes()]]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SHARDS, strict=True)], schema=_SHARDS)


def _shard_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shards: dict[str, _Shard] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = shards.setdefault(lang, _Shard())
                held -= shard.size
                shard.add(text)
                held += shard.size
                while held >= 2 * size or len(shards) > OPEN_LANGS or shard.size >= size:
                    full = max(shards, key=lambda name: shards[name].size)
                    held -= shards[full].size
                    yield (shard := shards.pop(full)).row(number, full)
                    number, shard = number + 1, _Shard()
        for lang, shard in shards.items():
            yield shard.row(number, lang)
            number += 1

    return cut


# ------------------------------------------------------------------ filters


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + _U(key)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


class Layout:
    """How n-grams of ids of ``id_bits`` bits lie in a filter cut into ``1 << slice_bits`` slices."""

    def __init__(self, words: int, id_bits: int, slice_bits: int) -> None:
        self.words, self.id_bits = words, id_bits
        self.left_bits, self.right_bits = id_bits * (words - words // 2), id_bits * (words // 2)
        self.slice_bits = min(slice_bits, self.left_bits)
        #: Bits of the left half that a slice itself does not tell.
        self.rest_bits = self.left_bits - self.slice_bits

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the n-grams that start at every id; ids are not 0 where it counts."""
        count = len(ids) - self.words + 1
        halves, middle = [], self.words - self.words // 2
        for first, last in ((0, middle), (middle, self.words)):
            half = np.zeros(count, _U)
            for i in range(first, last):
                half = (half << _U(self.id_bits)) | ids[i : i + count]
            halves.append(half)
        return halves[0], halves[1]

    def unpack(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        middle = self.words - self.words // 2
        out = []
        for half, first, last in ((left, 0, middle), (right, middle, self.words)):
            out += [(half >> _U(self.id_bits * (last - 1 - i))) & _mask(self.id_bits) for i in range(first, last)]
        return out

    def permute(self, left: np.ndarray, right: np.ndarray, undo: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each half is changed by a number that the other one gives, in turns, which can be undone."""
        for turn in (4, 3, 2, 1) if undo else (1, 2, 3, 4):
            if turn % 2:
                left = left ^ (_mixed(right, turn) & _mask(self.left_bits))
            else:
                right = right ^ (_mixed(left, turn) & _mask(self.right_bits))
        return left, right


def counted(left: np.ndarray, right: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their counts added up. ``bits``: of the right half."""
    if not len(left):
        return left, right, counts
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    new = left[1:] != left[:-1]
    if not (new | (right[1:] >= right[:-1])).all():
        inner = np.lexsort((right, left))
        order, left, right = order[inner], left[inner], right[inner]
        new = left[1:] != left[:-1]
    starts = np.flatnonzero(np.concatenate([[True], new | (right[1:] != right[:-1])]))
    return left[starts], right[starts], np.add.reduceat(counts[order], starts)


def _bytes(values: np.ndarray, bits: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _values(data: bytes, at: int, count: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, count * width, at).reshape(count, width)
    return out.view("<u8").ravel().astype(_U), at + count * width


def write_filter(left: np.ndarray, right: np.ndarray, counts: np.ndarray, layout: Layout) -> bytes:
    """One slice: sorted keys (the left half without the slice's own bits) and their counts."""
    size = len(left)
    quotient_bits = min(layout.rest_bits, max(0, size.bit_length() - 1))
    low_bits = layout.rest_bits - quotient_bits
    runs = np.zeros(size + (1 << quotient_bits), np.uint8)
    runs[(left >> _U(low_bits)).astype(np.int64) + np.arange(size)] = 1
    large = counts[counts >= 255]
    return b"".join(
        [
            np.array([size, quotient_bits, len(large)], "<u4").tobytes(),
            np.packbits(runs).tobytes(),
            _bytes(left & _mask(low_bits), low_bits),
            _bytes(right, layout.right_bits),
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            large.astype("<u8").tobytes(),
        ]
    )


def read_filter(data: bytes, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys and counts that :func:`write_filter` was given."""
    size, quotient_bits, large = map(int, np.frombuffer(data, "<u4", 3))
    low_bits, at = layout.rest_bits - quotient_bits, 12
    length = size + (1 << quotient_bits)
    runs = np.unpackbits(np.frombuffer(data, np.uint8, -(-length // 8), at), count=length)
    at += -(-length // 8)
    quotients = (np.flatnonzero(runs) - np.arange(size)).astype(_U)
    low, at = _values(data, at, size, low_bits)
    right, at = _values(data, at, size, layout.right_bits)
    counts = np.frombuffer(data, np.uint8, size, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", large, at + size)
    return (quotients << _U(low_bits)) | low, right, counts


def slices(ids: np.ndarray, layout: Layout) -> Iterator[tuple[int, bytes]]:
    """The filter of a sequence of ids, slice by slice; no n-gram holds an id of 0."""
    if len(ids) < layout.words:
        return
    count = len(ids) - layout.words + 1
    whole = np.logical_and.reduce([ids[i : i + count] > 0 for i in range(layout.words)])
    left, right = layout.permute(*(half[whole] for half in layout.pack(ids)))
    left, right, counts = counted(left, right, np.ones(len(left), np.int64), layout.right_bits)
    own = left >> _U(layout.rest_bits)
    bounds = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else []
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        part = slice(start, end)
        yield int(own[start]), write_filter(left[part] & _mask(layout.rest_bits), right[part], counts[part], layout)


def _filter_rows(layouts: list[Layout]) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def build(shard: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for lang, data in zip(shard["lang"], shard["stream"], strict=True):
            stream = np.frombuffer(data, "<u4")
            table = np.zeros(int(stream.max()) + 1, _U)
            table[known["pos"].to_numpy() + 1] = known["id"].to_numpy().astype(_U)
            ids = table[stream]
            rows += [(lang, x.words, number, part) for x in layouts for number, part in slices(ids, x)]
        return pd.DataFrame(rows, columns=["lang", "words", "slice", "filter"])

    return build


def _merged_rows(layouts: list[Layout], least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    by_words = {x.words: x for x in layouts}

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        layout = by_words[int(rows["words"].iloc[0])]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        entries = 0

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return counted(*(np.concatenate(x) for x in zip(*held, strict=True)), layout.right_bits)

        for data in rows["filter"]:
            held.append(read_filter(data, layout))
            entries += len(held[-1][0])
            if entries > 2 * SLICE_ENTRIES + len(held[0][0]):
                held, entries = [joined()], 0
        left, right, counts = joined()
        enough = counts >= least
        left = left[enough] | (_U(int(rows["slice"].iloc[0])) << _U(layout.rest_bits))
        ids = layout.unpack(*layout.permute(left, right[enough], undo=True))
        ids += [np.zeros(len(left), _U)] * (MAX_WORDS - layout.words)
        return pd.DataFrame(
            {"lang": rows["lang"].iloc[0], "words": layout.words}
            | {name: x.astype(np.int64) for name, x in zip(_W, ids, strict=True)}
            | {"a": counts[enough]}
        )

    return merge


# ----------------------------------------------------------------- phrases


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases, the words in them, and the number of word occurrences.

    ``lang, words, w1 .. w4, a``: phrases of one to four words (ids, 0 beyond the last)
    that occur ``least`` times or more in a language; ``lang, word, id``; ``lang, n``.
    A phrase can be frequent only if its words are, so other words get no id.
    """
    spark = docs.sparkSession
    short_batches(spark)
    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    texts = docs.select(lang, F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    shards = materialise(texts.mapInArrow(_shard_rows(SHARD_WORDS), _SHARD_COLUMNS), "shards")
    seen = shards.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("a"))))
    frequent = seen.groupBy("lang", "word").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    words = materialise(row_numbers(frequent, ["lang", "word"], "id"), "words")
    in_shard = F.aggregate("counts", F.lit(0).cast("long"), lambda n, x: n + x)
    totals = shards.groupBy("lang").agg(F.sum(in_shard).alias("n"))
    # one number each: of the ids and of all words
    vocabulary = words.agg(F.max("id")).first()[0] or 0
    total = totals.agg(F.sum("n")).first()[0] or 0
    slice_bits = (total // SLICE_ENTRIES).bit_length()
    layouts = [Layout(n, max(1, vocabulary.bit_length()), slice_bits) for n in range(2, MAX_WORDS + 1)]
    known = (
        shards.select("shard", "lang", F.posexplode("words").alias("pos", "word"))
        .join(words, ["lang", "word"])
        .select(F.col("shard").alias("owner"), "pos", "id")
    )
    filters = (
        shards.select("shard", "lang", "stream")
        .groupBy("shard")
        .cogroup(known.groupBy("owner"))
        .applyInPandas(_filter_rows(layouts), "lang string, words int, slice long, filter binary")
    )
    merged = filters.groupBy("lang", "words", "slice").applyInPandas(
        _merged_rows(layouts, least), "lang string, words int, w1 long, w2 long, w3 long, w4 long, a long"
    )
    single = words.select("lang", F.lit(1).alias("words"), F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in _W[1:]], "a")
    return materialise(merged.unionByName(single), "phrases"), words, totals


def _part(first: int, count: int) -> list[Column]:
    """The words from ``first`` (from 0), ``count`` of them at most, as a phrase's ids."""
    inside = [F.col(_W[first + i]) if i < count and first + i < MAX_WORDS else F.lit(0).cast("long") for i in range(MAX_WORDS)]
    return [c.alias(w) for c, w in zip(inside, _W, strict=True)]


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with their lowest-scoring cut: ``k, l, r, score``.

    Ties go to the smallest k. Numbers are decimals where a product may pass 64 bits.
    """
    cuts = F.array_compact(
        F.array(
            *(
                F.when(F.col("words") > k, F.struct(F.lit(k).alias("k"), F.struct(*_part(0, k)).alias("first"), F.struct(*_part(k, MAX_WORDS)).alias("rest")))
                for k in range(1, MAX_WORDS)
            )
        )
    )
    counts = phrases.select(F.struct(*_W).alias("key"), F.col("a").alias("f"))
    cut = phrases.filter("words > 1").select("lang", "words", *_W, "a", F.inline(cuts))
    cut = cut.join(counts.select(F.col("key").alias("first"), F.col("f").alias("l")), "first")
    cut = cut.join(counts.select(F.col("key").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr(f"cast((cast(a as decimal(20, 0)) * {SCALE}) div (cast(l as decimal(20, 0)) + r) as long)")
    lowest = cut.groupBy("lang", "words", *_W, "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "words", *_W, "a", "cut.*")


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates that no longer candidate holds in ``covered`` percent or more of their occurrences."""
    parts = F.array_compact(
        F.array(
            *(
                F.when(F.col("words") == n, F.struct(*_part(first, count)))
                for n in range(3, MAX_WORDS + 1)
                for count in range(2, n)
                for first in range(n - count + 1)
            )
        )
    )
    inside = candidates.filter("words > 2").select(F.col("a").alias("longer"), F.inline(parts))
    most = inside.groupBy(*_W).agg(F.max("longer").alias("longer"))
    kept = F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered)
    return candidates.join(most, _W, "left").filter(kept).drop("longer")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` collocations.

    Only A-Z are lower-cased. Words are what stands between blanks and tabs within a
    piece of text; pieces end at ``. , ; : ! ?`` and at line ends, and with the text.
    A null text is empty, a null lang counts as ``und`` together with what is named
    so; rows that repeat count each time; only ``lang`` and ``text`` are read, whatever
    other columns there are. Without a candidate (as in an empty table) there are no rows. Ties in
    score go to the larger count, then to the phrase that sorts first by its bytes.
    """
    phrases, words, totals = phrase_counts(docs, least)
    found = uncovered(scored(phrases))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # all ties stay until the phrase itself decides
    found = found.withColumn("rank", F.rank().over(best)).filter(F.col("rank") <= top).drop("rank")
    spelt = (
        found.select("lang", *_W, "a", "l", "r", "score", F.posexplode(F.array(*_W)).alias("pos", "id"))
        .filter("id > 0")
        .join(words.select("id", "word"), "id")
        .groupBy("lang", *_W, "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("spelt"))
        .withColumn("phrase", F.array_join(F.col("spelt.word"), " "))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = spelt.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB twin over table ``documents``.
SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i:i + words - 1], ' '))) AS phrase
  FROM worded, range(1, {MAX_WORDS + 1}) AS sizes(words) WHERE len(w) >= words
), counts AS (
  SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), candidates AS (
  SELECT lang, words, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE words > 1
), cut AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM candidates c, range(1, {MAX_WORDS}) AS places(k) WHERE k < words
), scores AS (
  SELECT c.lang, c.words, c.phrase, a, k, p.f AS l, q.f AS r,
    CAST(a AS HUGEINT) * {SCALE} // (CAST(p.f AS HUGEINT) + q.f) AS score
  FROM cut c JOIN counts p ON p.lang = c.lang AND p.phrase = head JOIN counts q ON q.lang = c.lang AND q.phrase = tail
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a AS longer, unnest(list_transform(range(1, words - count + 2), lambda i: array_to_string(w[i:i + count - 1], ' '))) AS phrase
  FROM candidates, range(2, {MAX_WORDS}) AS sizes(count) WHERE count < words
), cover AS (
  SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY lang, phrase
)
SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank,
  x.phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest x JOIN totals USING (lang) LEFT JOIN cover c ON c.lang = x.lang AND c.phrase = x.phrase
WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < {COVERED} * CAST(a AS HUGEINT)
QUALIFY rank <= {TOP}
"""
