"""Plain Parquet by date: root/date=<day>/*.parquet, readable by any tool that reads Parquet.

There is no log beside the data. Appends add files, and a reader gives the
schema it wants: columns that older files lack are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.functions.filters import as_date, date_range, optional_user
from meterlake.functions.keyed import without_known
from meterlake.schemas import ARCHIVE_AFTER_DAYS, ARCHIVE_COLUMNS, INTERACTION

ARCHIVE = StructType([f for f in INTERACTION if f.name in ARCHIVE_COLUMNS])


def write_days(rows: DataFrame, root: str, mode: str = "append", columns: list[str] = ARCHIVE_COLUMNS) -> None:
    """Write rows under their dates: the given columns, then any others but metadata.

    "append" adds files, "overwrite" replaces the dates that rows has and no
    other. One exchange gives files of an even size; a date with much of the
    data is split. Without rows the folder is made and nothing else changes.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    extra = [c for c in rows.columns if c not in columns and c != "metadata"]
    writer = rows.select(*columns, *extra).hint("rebalance", F.col("date")).write.mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root)


def read_days(
    spark: SparkSession, root: str, start=None, end=None, user_id: str | None = None, limit: int | None = None,
    schema: StructType = ARCHIVE,
) -> DataFrame:
    """Inclusive date range (only its folders are read), optional user, optional unordered limit (0: none)."""
    rows = spark.read.schema(schema).parquet(root).select(*[f.name for f in schema])
    rows = optional_user(date_range(rows, start, end), user_id)
    return rows.limit(limit) if limit else rows


def split_by_age(facts: DataFrame, as_of, days: int = ARCHIVE_AFTER_DAYS) -> tuple[DataFrame, DataFrame]:
    """(rows to move, rows to keep): older than as_of - days, and the rest."""
    cutoff = F.date_sub(as_date(as_of), days)
    return facts.where(F.col("date") < cutoff), facts.where(F.col("date") >= cutoff)


def archived_before(old: DataFrame, root: str) -> DataFrame:
    """Ids that the archive holds on the dates of the rows to be moved; other dates are not read.

    There is one row per date, so the list of dates is as short as the calendar.
    """
    dates = F.broadcast(old.select("date").distinct())
    return read_days(old.sparkSession, root).join(dates, "date", "left_semi").select("interaction_id")


def move_days(facts: DataFrame, root: str, as_of, days: int = ARCHIVE_AFTER_DAYS) -> DataFrame:
    """Archive the rows older than days, and return what stays in the warm table.

    Rows that the archive has already are not written again, so a move that
    failed before the warm table was rewritten can be repeated. A row keeps its
    date, so only the dates being moved are looked at.
    """
    old, keep = split_by_age(facts, as_of, days)
    write_days(old.limit(0), root)  # the folder
    write_days(without_known(old, archived_before(old, root), ["interaction_id"]), root)
    return keep


def read_all_tiers(warm: DataFrame, archive: DataFrame) -> DataFrame:
    """Warm and archived rows together; a row in both tiers counts once, warm first."""
    cold_only = without_known(archive, warm, ["interaction_id"])
    return warm.unionByName(cold_only, allowMissingColumns=True)
