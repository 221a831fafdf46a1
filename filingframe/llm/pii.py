"""Personal data by candidate gradient boosting, in Column expressions only.

Strict patterns find what is written as usual (the base). Generators of high recall
propose overlapping spans besides: spelt and bracketed signs, other separators,
missing prefixes. Boosted trees score a proposal by its format and its context, and
a proposal is taken above a threshold that is calibrated for its kind. The trees
learn from the table itself: from base spans, written in disguise or spoilt, and
from what the generators propose where nothing is found. Positions are sums of the
lengths between matches, so no text is walked through by a user function.

All patterns are linear in the text: loops are possessive, and a match starts only
where a run of its characters starts or the match before it has ended.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingframe.llm.common import let
from filingframe.session import materialise

KINDS = ("email", "ip", "card", "phone")
#: Distinct base spans and distinct proposals of a kind that are learned from, at most.
SPANS, PROPOSALS = 2_000, 20_000
#: Share of the right spans among those above a threshold, right and wrong ones weighing the same in total.
PRECISION = 0.9
ROUNDS, RATE, LEAST_WEIGHT = 24, 0.4, 1.0
_CONTEXT = 24

_AT = r"(?:[ \t]?[@＠][ \t]?|[ \t]?[\[({<][ \t]?(?i:at|@)[ \t]?[\])}>][ \t]?|[ \t](?i:at)[ \t])"
_DOT = r"(?:\.|[ \t]?[\[({<][ \t]?(?i:dot|\.)[ \t]?[\])}>][ \t]?|[ \t](?i:dot)[ \t])"
_IP_DOT = r"(?:[ \t]?[\[({<][ \t]?(?i:dot|\.)[ \t]?[\])}>][ \t]?|[ \t](?i:dot)[ \t]|\.[ \t]?|[ \t]\.)"
_NAME = r"[A-Za-z0-9._%+-]"
_HOST = r"[A-Za-z0-9-]++"

BASE = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@{_HOST}(?:\.{_HOST})++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"{_NAME}(?<!{_NAME}{_NAME}){_NAME}*+{_AT}{_HOST}(?:{_DOT}{_HOST}){{1,6}}+",
    "ip": rf"[0-9](?<![0-9A-Za-z.][0-9])[0-9]{{0,2}}+(?:{_IP_DOT}[0-9]{{1,3}}+){{3}}+(?![0-9A-Za-z])",
    "card": r"[0-9](?<![0-9A-Za-z][0-9])(?:[ ./_\t-]{0,2}+[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?=[+(0-9])(?<![0-9A-Za-z+.,/-])(?:\+|00)?+(?:[0-9]{1,3}+[ ./-]{1,2}+)?+\(?+[0-9]{2,4}+\)?+(?:[ ./-]{1,2}+[0-9]{2,8}+){1,5}+(?![0-9A-Za-z])",
}
#: What a text must hold for a wide pattern to match at all.
_NEEDS = {"email": f"{_AT}{_HOST}{_DOT}[A-Za-z0-9-]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
_CUES = {
    "email": "(?i)(mail|contact|write|reach|courriel|correo|address|adresse)",
    "ip": r"(?i)(\bip\b|host|server|addr|ping|connect)",
    "card": "(?i)(card|visa|carte|karte|tarjeta|credit|paid|pay)",
    "phone": "(?i)(tel|phone|call|fax|mobil|móvil|whatsapp|dial)",
}
FEATURES = ("digits", "parts", "checked", "cue", "left", "right", "style", "dots", "ending")
_KEY = ["doc_id", "text_hash"]
Pattern = tuple[tuple[int, ...], float, float]
Tree = tuple[int, int, tuple[int, int, float, float], tuple[int, int, float, float]]


# -------------------------------------------------------------------- spans


def _finds(text: Column, pattern: str) -> Column:
    """Every match: its text, the length of what lies before it, and what stands beside it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(
        F.split(text, pattern, -1),
        lambda pieces: F.transform(
            matches,
            lambda m, i: F.struct(
                i.alias("no"),
                F.length(pieces[i]).alias("gap"),
                m.alias("found"),
                F.right(pieces[i], F.lit(_CONTEXT)).alias("before"),
                F.left(pieces[i + 1], F.lit(_CONTEXT)).alias("after"),
            ),
        ),
    )


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check that card numbers end with."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    )
    return F.aggregate(doubled, F.lit(0), lambda n, d: n + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _octets(found: Column) -> Column:
    numbers = F.regexp_extract_all(found, F.lit("0*+([0-9]*+)"), F.lit(1))
    return F.forall(numbers, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))


def _valid(kind: Column, found: Column) -> Column:
    digits = _digits(found)
    count = F.length(digits)
    return (
        F.when(kind == "ip", _octets(found))
        .when(kind == "card", F.when(count.between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", count.between(8, 15))
        .otherwise(True)
    )


def spans(docs: DataFrame) -> DataFrame:
    """Base spans and proposals: ``doc_id, text_hash, kind, base, start, finish, found, before, after, island``.

    Positions are code points from 0, ``finish`` exclusive. An island is a run of spans that overlap;
    it is named by where it starts. Rows that repeat in doc_id and text count once, null texts are empty.
    """
    text = F.col("text")
    sources = [(kind, base, (BASE if base else WIDE)[kind]) for base in (True, False) for kind in KINDS]
    found = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(base).alias("base"),
                F.when(text.contains("@") if base and kind == "email" else text.rlike(_NEEDS[kind]), _finds(text, pattern)).alias("finds"),
            )
            for kind, base, pattern in sources
        )
    )
    rows = (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
        .select(*_KEY, F.explode(found).alias("source"))
        .select(*_KEY, "source.kind", "source.base", F.inline("source.finds"))
        .repartition(*map(F.col, _KEY))
        .dropDuplicates([*_KEY, "kind", "base", "no"])
    )
    order = Window.partitionBy(*_KEY, "base", "kind").orderBy("no")
    placed = rows.withColumn("finish", F.sum(F.col("gap") + F.length("found")).over(order))
    placed = placed.withColumn("start", F.col("finish") - F.length("found")).drop("gap", "no")
    right = placed.filter(~F.col("base") | _valid(F.col("kind"), F.col("found")))
    by_start = Window.partitionBy(*_KEY).orderBy("start", "finish", F.desc("base"), "kind")
    reach = F.max("finish").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.coalesce(F.col("start") >= reach, F.lit(True)), F.col("start"))
    return right.withColumn("fresh", fresh).withColumn("island", F.max("fresh").over(by_start)).drop("fresh")


# ----------------------------------------------------------------- features


def _beside(character: Column) -> Column:
    """0 nothing or white space, 1 a sign that ends or opens a phrase, 2 any other sign, 3 a letter or digit."""
    return (
        F.when((character == "") | character.rlike(r"\s"), 0)
        .when(character.rlike(r"[.,;:!?()\"'\[\]<>]"), 1)
        .when(character.rlike(r"[\p{L}\p{N}]"), 3)
        .otherwise(2)
    )


def features(kind: Column, found: Column, before: Column, after: Column) -> list[Column]:
    """The format and context of a span, in small whole numbers."""
    digits = _digits(found)
    count = F.length(digits)
    spelt = F.when(found.rlike(r"[ \t](?i:at|dot)[ \t]"), 2).when(found.rlike(r"[\[({<]"), 1).otherwise(0)
    prefix = (
        F.when(found.startswith("+"), 0).when(found.startswith("00"), 1).when(found.startswith("("), 2).otherwise(3)
    )
    host = F.regexp_extract(found, "([A-Za-z0-9-]+)$", 1)
    words = F.when(found.rlike(r"(?i)\bdot\b|[\[({<] ?\."), 1).otherwise(0)
    cue = F.coalesce(*(F.when(kind == k, before.rlike(p)) for k, p in _CUES.items()), F.lit(False))
    values = {
        "digits": F.least(count, F.lit(24)),
        "parts": F.least(F.regexp_count(found, F.lit("[A-Za-z0-9]+")), F.lit(12)),
        "checked": F.when(kind == "card", luhn(digits)).when(kind == "ip", _octets(found)).otherwise(False).cast("int"),
        "cue": cue.cast("int"),
        "left": _beside(F.right(before, F.lit(1))),
        "right": _beside(F.left(after, F.lit(1))),
        "style": F.when(kind == "email", spelt).when(kind == "phone", prefix).otherwise(
            F.when(found.rlike("[/_]"), 4).when(found.rlike(r"\s"), 3).when(found.contains("-"), 2).when(found.contains("."), 1).otherwise(0)
        ),
        "dots": F.when(kind.isin("email", "ip"), words).otherwise(F.least(F.regexp_count(found, F.lit("[^0-9]")), F.lit(9))),
        "ending": F.when((kind == "email") & ~host.rlike("^[A-Za-z]{2,}$"), 0).otherwise(F.least(F.length(host), F.lit(9))),
    }
    return [values[name].cast("int").alias(name) for name in FEATURES]


def _variants(kind: Column, found: Column) -> Column:
    """A base span in disguise (right) or spoilt (wrong)."""
    name, host = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
    digits = _digits(found)

    def joined(at: str, dot: str) -> Column:
        return F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))

    def dotted(dot: str) -> Column:
        return F.replace(found, F.lit("."), F.lit(dot))

    def grouped(sign: str, sizes: Sequence[int], value: Column = digits) -> Column:
        places = [sum(sizes[:i]) + 1 for i in range(len(sizes))]
        return F.concat_ws(sign, *(F.substr(value, F.lit(p), F.lit(n)) for p, n in zip(places, sizes, strict=True)))

    last = F.translate(F.right(digits, F.lit(1)), "0123456789", "1234567890")
    spoilt = F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), last)
    ten = F.right(digits, F.lit(10))
    us = F.concat(F.lit("("), F.left(ten, F.lit(3)), F.lit(") "), F.substr(ten, F.lit(4), F.lit(3)), F.lit("-"), F.right(ten, F.lit(4)))
    made = {
        "email": (
            [joined(*x) for x in ((" at ", " dot "), (" AT ", " DOT "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("(at)", "."), ("＠", "."), (" @ ", "."))],
            [F.concat(name, F.lit(" at "), host), F.concat(name, F.lit("@"), F.lit("1.2")), F.concat(name, F.lit(" at "), host, F.lit(".7"))],
        ),
        "ip": (
            [dotted(x) for x in ("[.]", "(.)", "[dot]", "(dot)", " dot ")],
            [dotted(x) for x in (". ", " .")] + [F.regexp_replace(found, "^[0-9]+", "999"), F.replace(F.regexp_replace(found, "[0-9]+$", "256"), F.lit("."), F.lit("[.]"))],
        ),
        "card": (
            [grouped(x, (4, 4, 4, 4, 3)) for x in (".", "/", "_", "  ", ". ", "--")] + [F.regexp_replace(grouped("-", (4, 4, 4, 4, 3)), "-$", "")],
            [grouped(x, (4, 4, 4, 4, 3), spoilt) for x in ("", " ", "-", ".", "/", "_", "  ")] + [spoilt],
        ),
        "phone": (
            [us, grouped("-", (3, 3, 4), ten), grouped(".", (3, 3, 4), ten), F.concat(F.lit("00"), grouped(" ", (2, 3, 3, 4))), F.concat(F.lit("+"), grouped("/", (2, 3, 3, 4)))],
            [grouped("-", (4, 2, 2)), grouped(".", (2, 2, 4)), grouped("/", (2, 2, 4)), grouped(" ", (2, 2, 2, 2)), grouped(" ", (4, 4)), grouped(".", (2, 3)), grouped(" ", (3, 3)), grouped(".", (3, 3, 3)), grouped("-", (4, 4)), grouped(" ", (4, 4, 4, 4))],
        ),
    }
    rows = [
        F.when(kind == k, F.struct(F.regexp_replace(value, r"[ ./_-]+$", "").alias("variant"), F.lit(right).alias("right_one")))
        for k, both in made.items()
        for right, values in zip((1, 0), both, strict=True)
        for value in values
    ]
    return F.array_compact(F.array(*rows))


# ----------------------------------------------------------------- learning


def _least(df: DataFrame, by: Sequence[str], count: int) -> DataFrame:
    """``count`` rows of each kind, those with the least hashes."""
    order = Window.partitionBy("kind").orderBy(F.xxhash64(*by), *by)
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count).drop("place")


def examples(found: DataFrame) -> DataFrame:
    """``kind``, FEATURES, ``calibrates, good, bad``: how often each vector is right and wrong.

    Copies count once: base spans are distinct in what is found, proposals in what is
    found and what stands before it. A proposal that overlaps a base span of its kind
    is right, one that overlaps none at all is wrong, and others are not learned from.
    """
    island = [*_KEY, "island"]
    known = found.filter("base").groupBy(*island).agg(F.collect_set("kind").alias("known"))
    met = found.filter("not base").join(
        known.select(*[F.col(c).alias(f"own_{c}") for c in island], "known"),
        (F.col("doc_id").eqNullSafe(F.col("own_doc_id"))) & (F.col("text_hash") == F.col("own_text_hash")) & (F.col("island") == F.col("own_island")),
        "left",
    )
    right = F.when(F.col("known").isNull(), 0).when(F.array_contains("known", F.col("kind")), 1)
    proposals = (
        met.select("kind", "found", "before", "after", right.alias("right_one"))
        .filter("right_one is not null")
        .groupBy("kind", "found", "before")
        .agg(F.min("after").alias("after"), F.max("right_one").alias("right_one"))
    )
    proposals = _least(proposals, ["found", "before"], PROPOSALS)
    originals = found.filter("base").groupBy("kind", "found").agg(F.min(F.struct("before", "after")).alias("beside"))
    originals = _least(originals, ["found"], SPANS)
    pattern = F.coalesce(*(F.when(F.col("kind") == k, F.regexp_extract(F.concat(F.lit(" "), F.col("v.variant"), F.lit(" ")), p, 0)) for k, p in WIDE.items()))
    made = (
        originals.withColumn("v", F.explode(_variants(F.col("kind"), F.col("found"))))
        .filter(pattern == F.col("v.variant"))
        .select("kind", F.col("v.variant").alias("found"), "beside.before", "beside.after", F.col("v.right_one").alias("right_one"))
    )
    rows = proposals.select(made.columns).union(made)
    calibrates = (F.pmod(F.xxhash64("found"), F.lit(4)) == 0).alias("calibrates")
    vectors = rows.select("kind", "right_one", calibrates, *features(F.col("kind"), F.col("found"), F.col("before"), F.col("after")))
    return vectors.groupBy("kind", *FEATURES, "calibrates").agg(
        F.sum("right_one").alias("good"), F.sum(1 - F.col("right_one")).alias("bad")
    )


def _best(patterns: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, int, int, float, float]:
    """The cut of weighted vectors (vector, gradient, curvature) that gains most: gain, feature, bound, two leaves."""
    all_g, all_h = sum(p[1] for p in patterns), sum(p[2] for p in patterns)
    whole = all_g**2 / (all_h + 1)
    value = -all_g / (all_h + 1)
    best = (0.0, 0, 1 << 30, value, value)
    for feature in range(len(FEATURES)):
        sums: dict[int, list[float]] = {}
        for vector, g, h in patterns:
            own = sums.setdefault(vector[feature], [0.0, 0.0])
            own[0] += g
            own[1] += h
        g = h = 0.0
        for bound in sorted(sums)[:-1]:
            g, h = g + sums[bound][0], h + sums[bound][1]
            gain = g * g / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - whole
            if gain > best[0] + 1e-9:
                best = (gain, feature, bound, -g / (h + 1), -(all_g - g) / (all_h - h + 1))
    return best


def _value(tree: Tree, vector: Sequence[int]) -> float:
    feature, bound, low, high = tree
    own = low if vector[feature] <= bound else high
    return own[2] if vector[own[0]] <= own[1] else own[3]


def boost(patterns: Iterable[Pattern]) -> list[Tree]:
    """Trees of depth two that separate right from wrong vectors (vector, right, wrong), both of equal weight."""
    patterns = list(patterns)
    right, wrong = sum(p[1] for p in patterns), sum(p[2] for p in patterns)
    if not right or not wrong:
        return []
    scale = (right + wrong) / 2
    weighted = [(v, good * scale / right, bad * scale / wrong) for v, good, bad in patterns]
    sums, trees = [0.0] * len(weighted), []
    for _ in range(ROUNDS):
        slopes = []
        for (vector, good, bad), s in zip(weighted, sums, strict=True):
            p = 1 / (1 + math.exp(-s))
            slopes.append((vector, (good + bad) * p - good, (good + bad) * p * (1 - p)))
        _, feature, bound, _, _ = _best(slopes)
        sides = []
        for low in (True, False):
            _, *cut = _best([x for x in slopes if (x[0][feature] <= bound) == low])
            sides.append((cut[0], cut[1], RATE * cut[2], RATE * cut[3]))
        tree = (feature, bound, *sides)
        trees.append(tree)
        sums = [s + _value(tree, v) for (v, _, _), s in zip(weighted, sums, strict=True)]
    return trees


def total(trees: list[Tree], vector: Sequence[int]) -> float:
    return sum(_value(tree, vector) for tree in trees)


def threshold(trees: list[Tree], patterns: Iterable[Pattern]) -> float | None:
    """A sum above which right vectors make up PRECISION, the least there is; None if there is none.

    It lies halfway between two sums, so that none is ever a matter of rounding.
    """
    rows = sorted(((total(trees, v), good, bad) for v, good, bad in patterns), reverse=True)
    all_good, all_bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not trees or not all_good:
        return None
    best, good, bad = None, 0.0, 0.0
    for i, (score, a, b) in enumerate(rows):
        good, bad = good + a / all_good, bad + b / max(all_bad, 1)
        below = rows[i + 1][0] if i + 1 < len(rows) else 0.0
        if below < score - 1e-6 and score > 0 and good >= PRECISION * (good + bad):
            best = (score + max(below, 0.0)) / 2
    return best


Model = dict[str, tuple[list[Tree], float]]


def fit(found: DataFrame) -> Model:
    """Trees and threshold of each kind. Only counted vectors of the bounded examples come to the driver.

    A kind without a base span, or without a threshold that is precise enough, has no model: nothing is added to it.
    """
    learned: dict[str, tuple[list[Pattern], list[Pattern]]] = {k: ([], []) for k in KINDS}
    for row in examples(found).collect():
        vector = tuple(row[name] for name in FEATURES)
        learned[row["kind"]][row["calibrates"]].append((vector, row["good"], row["bad"]))
    model = {}
    for kind, (rows, rest) in learned.items():
        trees = boost(sorted(rows))
        bound = threshold(trees, rest)
        if bound is not None:
            model[kind] = (trees, bound)
    return model


# ---------------------------------------------------------------- selection


def _sum(trees: list[Tree]) -> Column:
    columns = [F.col(name) for name in FEATURES]

    def value(tree: Tree) -> Column:
        feature, bound, *sides = tree
        low, high = (F.when(columns[f] <= b, F.lit(x)).otherwise(F.lit(y)) for f, b, x, y in sides)
        return F.when(columns[feature] <= bound, low).otherwise(high)

    return F.aggregate(F.array(*map(value, trees)), F.lit(0.0), lambda s, x: s + x)


def selected(found: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_hash, kind, base, start, finish, score`` of the base spans and of the proposals taken.

    Of the spans of an island, base spans stay, and proposals give way to them; without
    a base span the proposal that stands highest above its threshold is taken, then the first and longest.
    """
    scored = found.select("*", *features(F.col("kind"), F.col("found"), F.col("before"), F.col("after")))
    above = F.lit(None).cast("double")
    for kind, (trees, bound) in model.items():
        above = F.when(F.col("kind") == kind, _sum(trees) - F.lit(bound)).otherwise(above)
    scored = scored.withColumn("above", F.when(~F.col("base"), above))
    taken = scored.filter("base or above >= 0").select(*_KEY, "island", "kind", "base", "start", "finish", "above")
    island = Window.partitionBy(*_KEY, "island")
    known = taken.withColumn("known", F.max("base").over(island)).filter("base or not known")
    first = F.row_number().over(island.orderBy(F.desc("base"), F.desc("above"), "start", F.desc("finish"), "kind"))
    score = F.when(F.col("base"), 1.0).otherwise(1 / (1 + F.exp(-F.col("above"))))
    return known.withColumn("place", first).filter("base or place = 1").select(*_KEY, "kind", "base", "start", "finish", score.alias("score"))


def _written(rows: Column) -> Column:
    """``kind:start:end`` of sorted structs, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"])
    return F.array_join(
        F.transform(rows, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["finish"].cast("string"))), ","
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` of every row of ``docs``.

    The counts and ``base_spans`` hold the base alone, ``spans`` also what the model adds; both are lists of
    ``kind:start:end`` by kind, then start. A null text is an empty text without spans. Rows that
    repeat give repeated results, rows without id are told apart by their texts, an empty table gives no rows,
    and only ``doc_id`` and ``text`` are read, whatever other columns there are.
    """
    found = materialise(spans(docs), "spans")
    taken = selected(found, fit(found))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("rank")
    one = F.struct(rank, "start", "finish")
    lists = taken.groupBy(*_KEY).agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
        F.array_sort(F.collect_list(F.when(F.col("base"), one))).alias("base_list"),
        F.array_sort(F.collect_list(one)).alias("list"),
    )
    lists = lists.select(
        *[F.col(c).alias(f"own_{c}") for c in _KEY],
        *(f"n_{k}" for k in KINDS),
        _written(F.col("base_list")).alias("base_spans"),
        _written(F.col("list")).alias("spans"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("own_doc_id")) & (F.col("text_hash") == F.col("own_text_hash"))
    return rows.join(lists, same, "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS),
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")),
    )


def redacted(docs: DataFrame, found: DataFrame, spans_column: str = "spans") -> DataFrame:
    """``doc_id, text`` of every row of ``docs`` with its spans overwritten by ``[kind]``.

    ``found`` has one row for each doc_id (unique there) and its written list of spans. A row without
    a match keeps its text; a null text stays null. Spans that overlap are overwritten as one, by the first one's kind.
    """
    lists = found.select(F.col("doc_id").alias("own_doc_id"), F.split(spans_column, ",").alias("own_spans"))
    joined = docs.select("doc_id", "text").join(lists, F.col("doc_id").eqNullSafe(F.col("own_doc_id")), "left")
    ranges = F.array_sort(
        F.transform(
            F.filter("own_spans", lambda s: s != ""),
            lambda s: F.struct(
                F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"),
                F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("finish"),
                F.split_part(s, F.lit(":"), F.lit(1)).alias("kind"),
            ),
        )
    )
    begun = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.col("text")

    def step(done: Column, r: Column) -> Column:
        between = F.substr(text, done["at"] + 1, F.greatest(r["start"] - done["at"], F.lit(0)))
        added = F.when(r["start"] >= done["at"], F.concat(done["out"], between, F.lit("["), r["kind"], F.lit("]"))).otherwise(done["out"])
        return F.struct(added.alias("out"), F.greatest(done["at"], r["finish"]).alias("at"))

    whole = F.aggregate(ranges, begun, step, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text))))
    return joined.select("doc_id", F.when(F.size("own_spans") > 0, whole).otherwise(text).alias("text"))
