"""What the training-data operators share: reading, tables on the way, numbering rows, tokenizer files."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.plans.session import work_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back.

    Later steps then read files instead of computing df again, and a lost
    executor costs no more than the tasks that ran on it.
    """
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces_of(spark: SparkSession, factor: int = 4) -> int:
    """Number of pieces a large key is cut into; follows the cluster's shuffle setting."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, key: Sequence[str], tie: Sequence[str], name: str) -> DataFrame:
    """Add a gapless number from 0 within each key, without one task per key.

    Rows of a key are dealt over pieces by a hash of the tie columns, numbered
    inside a piece in the order of the tie columns, and shifted by the rows of
    the pieces before. Rows equal in key and tie may swap their numbers.
    """
    n = pieces_of(df.sparkSession)
    key, tie = list(key), list(tie)
    rows = df.withColumn("_piece", F.pmod(F.xxhash64(*tie), F.lit(n)).cast("int"))
    before = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*key, "_piece").agg(F.count("*").alias("_rows"))
    sizes = sizes.select(*key, "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*key, "_piece").orderBy(*tie)
    rows = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    out = rows.join(sizes, [*key, "_piece"])
    return out.withColumn(name, (F.col("_shift") + F.col("_rank")).cast("long")).drop("_piece", "_rank", "_shift")


def row_ref(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Two longs that name a row by its content: id and text hash.

    Rows equal in both are the same document, and get the same results.
    """
    smallest = F.lit(-(2**63)).cast("long")
    return F.struct(
        F.coalesce(F.col(doc_id).cast("long"), smallest).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("hash"),
    )


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """A vocabulary file, in the given folder or that of the installed package; asked for where the file is read."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
