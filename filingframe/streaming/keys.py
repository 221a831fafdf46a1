"""Which folders of a target may hold a key: bitmaps of hashed keys, kept beside the folders.

Folders are parts of the keys' hashes, 2^level of them; the level grows with the target, and
rows stay in the folders of the level at which they came. Bits are written before the rows
they stand for: bits without rows cost a read, rows without bits would be loaded twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL, PART = "key_level", "key_part"
# Level of a new target, rows of a folder from which on there are more folders, and bits of a
# folder: eight a row, so that a folder is read in vain for one key in eight at most.
FIRST_LEVEL, LAST_LEVEL = 5, 30
ROWS_PER_PART = 1 << 17
BITS = 8 * ROWS_PER_PART

_BITS = T.StructType(
    [
        T.StructField(LEVEL, T.IntegerType()),
        T.StructField(PART, T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("rows", T.LongType()),
    ]
)


def part_of(key: str, level: Column) -> Column:
    """Folder of a key at a level, by its hash."""
    return F.pmod(F.xxhash64(key), F.pow(F.lit(2), level).cast("bigint")).cast("int")


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(BITS)) + 1


def _table(spark: SparkSession, target: str) -> DataFrame:
    # readers of the target pass over folders with an underscore
    path = f"{target}/_keys"
    spark.createDataFrame([], _BITS).write.mode("ignore").parquet(path)
    return spark.read.schema(_BITS).parquet(path)


def place(rows: DataFrame, target: str, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``rows`` with the level and part of their folders; the bits of their keys are written."""
    known = _table(rows.sparkSession, target).agg(F.sum("rows").alias("n"), F.max(LEVEL).alias("level")).first()
    level = max(known["level"] or 0, FIRST_LEVEL)
    while level < LAST_LEVEL and (known["n"] or 0) > rows_per_part << level:
        level += 1
    placed = rows.withColumn(LEVEL, F.lit(level)).withColumn(PART, part_of(key, F.lit(level)))
    bits = placed.groupBy(LEVEL, PART, F.bitmap_bucket_number(_slot(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_slot(key))).alias("bits"), F.count(F.lit(1)).alias("rows")
    )
    bits.write.mode("append").parquet(f"{target}/_keys")
    return placed


def folders(batch: DataFrame, target: str, key: str) -> dict[int, list[int]]:
    """Parts by level that may hold a key of the batch; all that hold one are among them."""
    table = _table(batch.sparkSession, target)
    # at most as many numbers as there are levels
    levels = sorted(r[LEVEL] for r in table.select(LEVEL).distinct().collect())
    if not levels:
        return {}
    slot = _slot(key)
    probes = (
        batch.select(key)
        .distinct()
        .select(
            F.explode(F.array(*map(F.lit, levels))).alias(LEVEL),
            F.col(key).alias("_key"),
            F.bitmap_bucket_number(slot).alias("bucket"),
            F.bitmap_bit_position(slot).alias("_at"),
        )
        .select(LEVEL, part_of("_key", F.col(LEVEL)).alias(PART), "bucket", "_at")
        .distinct()
    )
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0
    found = probes.join(table, [LEVEL, PART, "bucket"]).where(is_set).select(LEVEL, PART).distinct()
    out: dict[int, list[int]] = {}
    # at most as many rows as there are folders
    for r in found.collect():
        out.setdefault(r[LEVEL], []).append(r[PART])
    return out
