"""Shards by jump consistent hashing (Lamping and Veach, 2014).

A key's shard is found by jumping forward through ever larger shard counts;
no table of a ring is kept, and going from n to n + 1 shards moves about one
row in n + 1, always into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import numbered

MULTIPLIER = np.uint64(2862933555777941757)  # fixed value of the published algorithm


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; every pass moves the keys that still jump."""
    state = keys.astype(np.uint64, copy=True)
    at = np.full(len(state), -1, dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    active = np.arange(len(state))
    while len(active):
        at[active] = ahead[active]
        state[active] = state[active] * MULTIPLIER + np.uint64(1)
        step = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[active] = ((at[active] + 1) * (2147483648.0 / step)).astype(np.int64)
        active = active[ahead[active] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard (0 to shards - 1) of a key column; the key is hashed to 64 bits first. A null key is a key."""

    @F.pandas_udf("int")
    def jump(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy().view(np.uint64), shards).astype(np.int32))

    return jump(F.xxhash64(key))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place every document: id, size, text_crc32, shard, slot, grown_shard.

    size is the UTF-8 length of the text plus 16; a null text counts as empty.
    slot numbers the documents of a shard without gaps from 0; it is found in
    pieces, so a shard never has to fit one task. grown_shard is the place with
    one shard more. Rows with one id (or without any) share a shard; each has
    a slot of its own. Other columns of docs are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col(id_col), shards).alias("shard"),
        shard_of(F.col(id_col), shards + 1).alias("grown_shard"),
    )
    return numbered(rows, ["shard"], ["id", "text_crc32", "size"], "slot")
