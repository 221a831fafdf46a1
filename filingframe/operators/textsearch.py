"""Search of names by the character n-grams they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingframe.functions.text import symbol_key
from filingframe.operators.skew import salted_join
from filingframe.session import materialise

# Fixed value: characters of an n-gram. Least similarity of a match.
GRAM, LEAST = 3, 0.5


def grams(name: Column) -> Column:
    """Distinct n-grams of a name with blanks around it; none for an empty or null name."""
    padded = F.concat(F.lit(" " * (GRAM - 1)), name, F.lit(" "))
    places = F.sequence(F.lit(1), F.length(padded) - GRAM + 1)
    return F.when(name != "", F.array_distinct(F.transform(places, lambda i: F.substr(padded, i, F.lit(GRAM)))))


# N-grams that a key of the index is made of, and the ratio of the sizes of one class.
TOGETHER, CLASS = 2, 1.25


def _rarest_first(names: DataFrame) -> DataFrame:
    """``name, side, size, grams``: how many n-grams a name has, and those of both sides, the rarest pairs first.

    ``names`` has distinct ``name, side`` rows. An n-gram of one side alone is never common.
    """
    each = names.select("name", "side", F.explode(grams(F.col("name"))).alias("gram"))
    sides = [F.count_if(F.col("side") == side) for side in (0, 1)]
    spread = each.groupBy("gram").agg((sides[0] * sides[1]).alias("n"))
    ranked = salted_join(each, spread, ["gram"])
    # a list is as long as its name
    met = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("n", "gram"))))
    listed = ranked.groupBy("name", "side").agg(F.count(F.lit(1)).cast("int").alias("size"), met.alias("l"))
    return listed.select("name", "side", "size", F.col("l.gram").alias("grams"))


def _keys(indexed: DataFrame, least: float) -> DataFrame:
    """``indexed`` with the keys by which two names meet: classes of both sizes, and n-grams that both have.

    Names of sizes a and b that are similar enough share ``least / (1 + least) * (a + b)`` n-grams.
    Those of a name that are not among its last ones, one fewer than that, hold one of them; with one
    more n-gram they hold two. A key is made of two, so lists are short where each of the two is not rare.
    """
    size_class = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(CLASS)) + 1e-9).cast("int")
    placed = indexed.withColumn("_own", size_class)
    # one row a class, of which there are as many as the logarithm of the longest name
    classes = placed.groupBy("side", "_own").agg(F.min("size").alias("_from"), F.max("size").alias("_to"))
    own = classes.withColumnRenamed("_from", "_own_from").drop("_to")
    other = classes.select(
        (1 - F.col("side")).alias("side"), F.col("_own").alias("_other"), F.col("_from").alias("_other_from"), "_to"
    )
    # rounding must not lose a pair that lies on the bound
    near = (F.col("_to") >= F.col("size") * least - 1e-9) & (F.col("size") >= F.col("_other_from") * least - 1e-9)
    both = placed.join(F.broadcast(own), ["side", "_own"]).join(F.broadcast(other), "side").where(near)
    shared = F.ceil((F.col("_own_from") + F.col("_other_from")) * (least / (1 + least)) - 1e-9).cast("int")
    both = both.withColumn("_shared", F.greatest(shared, F.lit(1)))
    at_once = F.least(F.col("_shared"), F.lit(TOGETHER))
    first = F.slice("grams", F.lit(1), F.greatest(F.size("grams") - F.col("_shared") + at_once, F.lit(0)))
    both = both.where(F.size("grams") >= F.col("_shared")).withColumn("_first", first)
    pairs = F.flatten(
        F.transform(
            "_first",
            lambda x, i: F.transform(F.slice("_first", i + 2, F.size("_first")), lambda y: F.concat(x, y)),
        )
    )
    keys = F.when(at_once == 1, F.col("_first")).otherwise(pairs)
    classed = [F.when(F.col("side") == 0, F.col(a)).otherwise(F.col(b)) for a, b in (("_own", "_other"), ("_other", "_own"))]
    return both.select(
        "side", "name", "grams", "size", classed[0].alias("q_class"), classed[1].alias("n_class"), F.explode(keys).alias("key")
    )


def similar_names(queries: DataFrame, names: DataFrame, least: float = LEAST) -> DataFrame:
    """``query, name, similarity`` of all pairs whose n-gram sets have a Jaccard similarity of ``least`` or more.

    Both tables have one column of text, compared by its symbol key. An inverted index
    holds pairs of the rarest n-grams of a name alone: two sets of that similarity share
    one of them, whatever the rest, so frequent n-grams make no list that anyone reads.
    Pairs may repeat if they share several; empty and null names match nothing. The n-grams
    of each name are written once in the shared folder.
    """
    if not 0 < least <= 1:
        raise ValueError("the least similarity lies above 0 and up to 1")
    sides = [
        df.select(symbol_key(df.columns[0]).alias("name"), F.lit(side).alias("side")).distinct()
        for side, df in enumerate((queries, names))
    ]
    posted = _keys(materialise(_rarest_first(sides[0].union(sides[1])), "grams"), least)
    key = ["q_class", "n_class", "key"]

    def side(number: int, prefix: str) -> DataFrame:
        own = posted.filter(F.col("side") == number)
        return own.select(*key, *[F.col(c).alias(f"{prefix}_{c}") for c in ("name", "grams", "size")])

    met = salted_join(side(0, "q"), side(1, "n"), key)
    q, n = F.col("q_size"), F.col("n_size")
    met = met.filter((n >= q * least - 1e-9) & (q >= n * least - 1e-9))
    common = F.size(F.array_intersect("q_grams", "n_grams"))
    similarity = common / (q + n - common)
    found = met.select(F.col("q_name").alias("query"), F.col("n_name").alias("name"), similarity.alias("similarity"))
    return found.filter(F.col("similarity") >= least)


def best_match(queries: DataFrame, names: DataFrame, least: float = LEAST) -> DataFrame:
    """``query, name, similarity``: the most similar name of each query that has one, ties to the first name."""
    best = F.min(F.struct((-F.col("similarity")).alias("rank"), "name")).alias("best")
    found = similar_names(queries, names, least).groupBy("query").agg(best)
    return found.select("query", "best.name", (-F.col("best.rank")).alias("similarity"))
