"""Rows that are equal in some columns, gathered so that a join settles them once.

The rows of a join of two sides with many equal keys grow with the product of both. What the join
compares and moves need not: each distinct key stands in one row with its copies, and pairs are
expanded only as they are returned, without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfield.session import data_partitions, durable, sized_broadcast

_COPIES = 256  # rows about, that are gathered in one


def gathered(df: DataFrame, keys: list[str], keep: list[str], name: str) -> tuple[DataFrame, bool]:
    """``keys`` and an array ``name`` of the ``keep`` columns of the rows that share them; whether rows were dealt for that.

    Where few rows share their keys each stands alone. A key of many rows has several arrays, of about
    ``_COPIES`` rows each, and these are dealt apart.
    """
    row = F.struct(F.lit(0).alias("_none"), *keep)
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*keys)).alias("groups")).first()
    if seen["rows"] < 2 * seen["groups"]:
        return df.select(*keys, F.array(row).alias(name)), False
    hashed = df.withColumn("_h", F.xxhash64(*keys))
    hot = durable(hashed.groupBy("_h").count().where(F.col("count") > _COPIES).select("_h", F.ceil(F.col("count") / _COPIES).cast("bigint").alias("_n")))
    if hot.isEmpty():
        parted = hashed.withColumn("_part", F.lit(0).cast("bigint"))
    else:
        mixed = [c for c in keep if "map<" not in df.schema[c].dataType.simpleString()]  # equal rows are parted by where they were read
        parted = hashed.join(sized_broadcast(hot), "_h", "left").withColumn("_part", F.pmod(F.xxhash64(*mixed, F.spark_partition_id()), F.coalesce("_n", F.lit(1).cast("bigint"))))
    dealt = parted.select("_h", "_part", *keys, row.alias("_row")).repartition(data_partitions(df), "_h", "_part")
    return dealt.groupBy("_h", "_part", *keys).agg(F.collect_list("_row").alias(name)).select(*keys, name), True


def many_to_many(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join by ``keys`` where both sides hold many rows per key: the columns of ``left``, then the others of ``right``.

    Only ``left`` is gathered. A row of ``right`` is made once and dealt once, and expands to its pairs where it meets its key.
    """
    rest = [c for c in right.columns if c not in keys]
    a, _ = gathered(left, keys, left.columns, "_left")
    b = right.select(*keys, F.struct(F.lit(0).alias("_none"), *rest).alias("_r"))
    pairs = a.join(b, keys).select("_r", F.explode("_left").alias("_l"))
    return pairs.select(*[F.col("_l")[c].alias(c) for c in left.columns], *[F.col("_r")[c].alias(c) for c in rest])
