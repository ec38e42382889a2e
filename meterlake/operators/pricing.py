"""Cost of a call from the price list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import checked_broadcast
from meterlake.schemas import price_table


def estimate_cost(df: DataFrame, prices: DataFrame | None = None, column: str = "cost_usd") -> DataFrame:
    """Add the cost of every row by its model; a model without a price costs 0.

    The default price list is a handful of rows and is broadcast. A list given
    by the caller is broadcast only when its counted size allows it.
    """
    small = F.broadcast(price_table(df.sparkSession)) if prices is None else checked_broadcast(prices)
    price_in = F.coalesce("price_in", F.lit(0.0))
    price_out = F.coalesce("price_out", F.lit(0.0))
    cost = F.col("input_tokens") / 1000 * price_in + F.col("output_tokens") / 1000 * price_out
    return df.join(small, "model", "left").withColumn(column, cost).drop("price_in", "price_out")
