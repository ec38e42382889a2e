"""Free SQL over the registered tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql_passthrough(spark: SparkSession, query: str, params: Sequence | Mapping | None = None) -> DataFrame:
    """Run SQL with ? (a list) or :name (a mapping) parameters, bound and never spliced.

    An error is raised; an empty result always means that there are no rows.
    """
    if params is None:
        return spark.sql(query)
    return spark.sql(query, args=dict(params) if isinstance(params, Mapping) else list(params))
