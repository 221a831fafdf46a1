"""Name search, joins on hot keys, functions of whole groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from filingframe.operators import aggregates, resolve, skew, textsearch


def gram_set(name):
    padded = f"  {name} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)} if name else set()


def brute_pairs(queries, names, least):
    out = {}
    for q in set(queries):
        for n in set(names):
            a, b = gram_set(q), gram_set(n)
            if a and b and len(a & b) / len(a | b) >= least:
                out[q, n] = len(a & b) / len(a | b)
    return out


def names_of(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choices("abپ 1", [5, 3, 2, 1, 2], k=rng.randrange(1, 9))).strip() for _ in range(count)]


@pytest.mark.parametrize("least", [0.2, 0.5, 2 / 3, 1.0])
def test_similar_names_equal_brute_force(spark, monkeypatch, least):
    # every key counts as hot here
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", 3))
    queries, names = names_of(1, 150), names_of(2, 150) + ["shared"] * 5
    queries += ["shared", "", None, "  "]
    frames = [spark.createDataFrame([(x,) for x in part], f"{c} string") for c, part in (("asked", queries), ("known", names + [None, ""]))]
    rows = {(r["query"], r["name"]): r["similarity"] for r in textsearch.similar_names(*frames, least).collect()}
    keyed = [" ".join((x or "").split()) for x in queries]
    want = brute_pairs(keyed, [" ".join(x.split()) for x in names], least)
    assert rows == pytest.approx(want)
    best = {r["query"]: r["name"] for r in textsearch.best_match(*frames, least).collect()}
    ranked = {}
    for (q, n), s in want.items():
        ranked.setdefault(q, []).append((-s, n.encode()))
    assert best == {q: min(x)[1].decode() for q, x in ranked.items()}


def test_search_refuses_senseless_bounds(spark):
    df = spark.createDataFrame([("a",)], "n string")
    with pytest.raises(ValueError, match="similarity"):
        textsearch.similar_names(df, df, 0)


def test_search_is_the_last_resort(spark):
    instruments = spark.createDataFrame(
        [("فولاد", "1", "10", "s", 1), ("فولادین", "2", "10", "s", 1)],
        "symbol string, ins_code string, isic_code string, sector_name string, z_titad long",
    )
    aliases = spark.createDataFrame([("فولادک", "2")], "alias string, ins_code string")
    asked = spark.createDataFrame([("فولاد",), ("فولادک",), ("فولادي",), ("نفت",)], "name string")
    found = resolve.resolve_instruments(asked, instruments, aliases, search=0.4)
    assert {r["name"]: r["ins_code"] for r in found.collect()} == {"فولاد": "1", "فولادک": "2", "فولادي": "1", "نفت": None}
    plain = resolve.resolve_instruments(asked, instruments, aliases)
    assert {r["name"]: r["ins_code"] for r in plain.collect()}["فولادي"] is None


@pytest.fixture
def plain_joins(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


def hot_rows(spark, count=9000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    day = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7)
    return spark.range(count).select(key.cast("string").alias("ins_code"), day.cast("int").alias("d_even"), "id")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_join_and_spreads_a_hot_key(spark, plain_joins, how):
    keys = ["ins_code", "d_even"]
    many = hot_rows(spark).union(spark.createDataFrame([(None, 1, -1), ("no", 1, -2)], "ins_code string, d_even int, id long"))
    few = spark.range(500).select(F.col("id").cast("string").alias("ins_code"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("d_even"), (F.col("id") * 2).alias("v"))
    salted = skew.salted_join(many, few, keys, how, rows_per_task=200)
    assert sorted(map(str, salted.select("ins_code", "d_even", "id", "v").collect())) == sorted(map(str, many.join(few, keys, how).select("ins_code", "d_even", "id", "v").collect()))
    hot = F.expr("ins_code = '0' and d_even = 1")
    spread = salted.filter(hot).groupBy(F.spark_partition_id().alias("p")).count()
    assert spread.count() >= 8 and spread.agg(F.max("count")).first()[0] < 3000 / 3
    alone = many.join(few, keys, how).filter(hot).groupBy(F.spark_partition_id().alias("p")).count()
    assert alone.count() == 1


def test_frequent_keys_are_bounded(spark):
    found = skew.frequent_keys(hot_rows(spark), ["ins_code", "d_even"], rows_per_task=500)
    (row,) = found.collect()
    assert row["salts"] == 7  # 3,001 rows
    assert skew.frequent_keys(hot_rows(spark).filter("false"), ["ins_code"]).count() == 0
    assert skew.frequent_keys(hot_rows(spark), ["id"], rows_per_task=0, most=10).count() <= 10
    with pytest.raises(ValueError, match="outer"):
        skew.salted_join(hot_rows(spark), hot_rows(spark), ["id"], "outer")


def test_holders_of_a_hot_day_are_spread(spark, plain_joins, monkeypatch):
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", 200))
    holders = hot_rows(spark).withColumn("shareHolderName", F.col("id").cast("string")).drop("id")
    prices = spark.createDataFrame([("0", 20200102, 5.0, 6.0)], "ins_code string, d_even int, pClosing double, pc double")
    holders = holders.withColumn("d_even", F.lit(20200102))
    target = spark.createDataFrame([("c", "d", "0")], "company string, assembly_date string, ins_code string").withColumn("day", F.to_date(F.lit("2020-01-01")))
    rows = resolve.as_of_forward(target, holders, prices)
    assert rows.count() == holders.filter("ins_code = '0'").count()
    assert rows.select("pClosing").distinct().collect() == [(5.0,)]
    assert rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000


def test_any_function_of_a_group(spark):
    rows = [("a", 1, 3.0, 9), ("a", 2, 5.0, 8), ("a", 3, 4.0, 7), ("b", 1, None, 1), ("b", 2, 1.0, 2), (None, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "_k0 string, at int, _value double, n int").repartition(3)
    spread = aggregates.GroupFunction(lambda s: "".join(f"{v:.0f}" for v in s.dropna()), "string", order="at")
    out = aggregates.group_by(df, "_k0", {"_value": spread, "n": "max"}).collect()
    assert sorted(map(tuple, out)) == [("a", "354", 9), ("b", "1", 2)]


@pytest.mark.parametrize("bounds", [{"max_rows": 100}, {"max_bytes": 400}])
def test_an_oversized_group_is_refused_by_name(spark, bounds):
    df = hot_rows(spark, 600)
    calls = aggregates.GroupFunction(lambda s: 1 / 0, "int", **bounds)
    with pytest.raises(aggregates.OversizedGroup, match="ins_code='0'.*200 rows"):
        aggregates.group_by(df, "ins_code", {"id": calls})


def test_names_of_frequent_ngrams_meet_few_others(spark):
    """Numbered names share most n-grams with all others; pairs of rare ones bring few together, and no match is lost."""
    queries = [f"Customer#{n:09d}" for n in range(0, 60_000, 199)] + ["", None, "ab", "a"]
    names = [f"Supplier#{n:09d}" for n in range(0, 40_000, 173)] + ["ab", "Customer of a supplier", ""]
    q = spark.createDataFrame([(n,) for n in queries], "name string")
    s = spark.createDataFrame([(n,) for n in names], "name string")

    def sets(name):
        padded = f"  {name} "
        return {padded[i : i + 3] for i in range(len(padded) - 2)}

    for least in (0.25, 0.5, 0.9):
        want = set()
        for a in filter(None, queries):
            for b in filter(None, names):
                common, both = len(sets(a) & sets(b)), len(sets(a) | sets(b))
                if common / both >= least:
                    want.add((a, b, round(common / both, 9)))
        found = textsearch.similar_names(q, s, least).collect()
        assert {(r.query, r.name, round(r.similarity, 9)) for r in found} == want
    sides = [df.select("name", F.lit(i).alias("side")).where("name != ''").distinct() for i, df in enumerate((q, s))]
    posted = textsearch._keys(textsearch._rarest_first(sides[0].union(sides[1])), 0.25)
    key = ["q_class", "n_class", "key"]
    left, right = (posted.where(F.col("side") == i).select(*key, F.col("name").alias(f"n{i}")) for i in (0, 1))
    met = left.join(right, key).select("n0", "n1").distinct().count()
    assert met < len(queries) * len(names) / 10
