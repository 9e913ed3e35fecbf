"""Helpers shared by the operators: written tables, ASCII lower-casing, distributed prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: a word is a maximal run of anything but ASCII white space
WORD = "[^\\x20\\x09-\\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/jobloom-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: the lineage ends here, and
    values that a recomputation could change (row numbers, partition ids) stay as they are."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the CRC-32 of an ASCII text: its bytes, each followed by eight shifts (-1)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, x: "
            "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)")


def running_totals(df: DataFrame, value: str, order: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the earlier rows of the same ``group``.

    A distributed prefix sum: range-sort by (group, order), sum each range, add up the sums of
    the ranges before, then sum inside each range. A group of any size spans many ranges, and only
    one row per range (and group) is summed in sequence. Group columns must not be null.
    """
    group, order = list(group), list(order)
    n = shuffle_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *group, *order).withColumn("range_no", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    sums = dealt.groupBy("range_no", *group).agg(F.sum(value).alias("range_sum"))
    earlier = Window.orderBy("range_no")
    if group:
        earlier = Window.partitionBy(*group).orderBy("range_no")
    sums = sums.select("range_no", *group, F.coalesce(
        F.sum("range_sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("range_before"))
    inside = Window.partitionBy("range_no", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(sums, ["range_no", *group])
            .withColumn("before", F.col("inside") + F.col("range_before"))
            .drop("inside", "range_before", "range_no"))


ROW = ("row_file", "row_number")


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a struct column that tells its rows apart, also those that are alike in all columns, and that column's name.

    Rows of Parquet files are named by file and row, which any later scan finds again. Other inputs are written once with a number.
    """
    name = f"row_{uuid.uuid4().hex[:8]}"
    try:
        place = F.struct(F.col("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))
        named = docs.withColumn(name, place)
        if not any("_metadata" == c.lower() for c in docs.columns):
            return named, name
    except AnalysisException:
        pass
    number = F.struct(F.lit("").alias(ROW[0]), F.monotonically_increasing_id().alias(ROW[1]))
    return written(docs.withColumn(name, number), "rows"), name


def keep_rows(docs: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``row`` struct is in the column ``row`` of ``kept``, without that column."""
    chosen = kept.select(*[F.col(f"{row}.{c}").alias(f"{row}_{c}") for c in ROW])
    same = [docs[row][c] == chosen[f"{row}_{c}"] for c in ROW]
    return docs.join(chosen, same, "left_semi").drop(row)


#: rows of one key that one task joins
SALTED = 1024


def join_salted(rows: DataFrame, side: DataFrame, key: Sequence[str], by: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side``, which has one row for each ``key``. Keys of more than ``SALTED`` rows are dealt out under several
    salts by a hash of ``by``, and their row of ``side`` goes to each. Keys must not be null where ``how`` is inner."""
    key = list(key)
    heavy = written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).filter(f"c > {SALTED}").select(
        *key, F.expr(f"cast(ceil(c / {SALTED}) as int)").alias("salts_")), "heavy-keys")
    left = rows.join(heavy, key, "left").withColumn("salt_", F.pmod(F.xxhash64(*by), F.coalesce("salts_", F.lit(1))).cast("int")).drop("salts_")
    right = side.join(heavy, key, "left").withColumn("salt_", F.explode(F.expr("sequence(0, coalesce(salts_, 1) - 1)"))).drop("salts_")
    return left.join(right, [*key, "salt_"], how).drop("salt_")
