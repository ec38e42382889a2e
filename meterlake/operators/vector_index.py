"""Exact nearest vectors by dot product, from an index that skips cells by a bound.

Rows are assigned to the nearest of some centres. With r the largest distance
of a cell's rows from its centre c, no row x of the cell scores more than

    q.x = q.c + q.(x - c) <= q.c + |q| r

against a probe q. A probe first looks into the cells with the highest bounds
until these hold k rows; its kth score there is a floor, and of the other cells
only those whose bound reaches the floor are looked into. The answer is that of
a full scan, however good or bad the centres are.

The centres are fitted on a bounded sample; everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import top_per_key

SAMPLE_ROWS = 20_000  # rows that the centres are fitted on
CENTRES_MOST = 1024
ROUNDS = 8
PART_ROWS = 8192  # rows of a cell that a task holds at once
PROBE_ROWS = 1024
# What a task holds of a matrix at once: rows against centres, probes against centres or a part's rows; and visits it gives at once.
AT_ONCE = 256
VISITS_AT_ONCE = 1 << 13
# What floating-point sums may lose against the bound.
SLACK = 1e-9


@dataclass
class Index:
    """rows: cell, part, id, vector. Centres, radius and parts are per cell; n is the number of rows."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray
    parts: np.ndarray
    n: int


def usable(df: DataFrame, id_column: str, embedding: str, dimension: int | None = None) -> DataFrame:
    """id, vector of the rows that can be compared: id and vector there, no null, NaN or infinite component, the right length."""
    vector = F.col(embedding).cast("array<double>")
    rows = df.select(F.col(id_column).alias("id"), vector.alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & (F.size("vector") > 0))
    return rows if dimension is None else rows.where(F.size("vector") == dimension)


def fit_centres(sample: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Lloyd's iterations from k distinct rows (fewer, if there are fewer)."""
    distinct = np.unique(sample, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        cell = nearest_centre(sample, centres)[0]
        count = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each vector, and its distance from the centre."""
    own = (centres**2).sum(axis=1)
    parts = np.split(vectors, range(AT_ONCE, len(vectors), AT_ONCE))
    cell = np.concatenate([(own - 2 * part @ centres.T).argmin(axis=1) for part in parts])
    return cell, np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))


def in_parts(pdf: pd.DataFrame, rows: int) -> Iterator[pd.DataFrame]:
    """pdf in parts of at most so many rows."""
    return (pdf.iloc[start : start + rows] for start in range(0, len(pdf), rows))


def build_index(
    corpus: DataFrame, path: str, id_column: str = "vec_id", embedding: str = "embedding", cells: int | None = None
) -> Index | None:
    """The index of all usable rows of the most common length, kept under path; None without any.

    cells defaults to the square root of the number of rows, up to CENTRES_MOST.
    """
    spark = corpus.sparkSession
    whole = usable(corpus, id_column, embedding)
    lengths = whole.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return None
    whole = whole.where(F.size("vector") == lengths.d)
    sample = whole.orderBy(F.xxhash64("id"), F.xxhash64("vector")).limit(SAMPLE_ROWS).select("vector").toPandas()
    k = cells or min(max(int(lengths.n**0.5), 1), CENTRES_MOST)
    centres = spark.sparkContext.broadcast(fit_centres(np.stack(sample["vector"].to_numpy()), k))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell, distance = nearest_centre(np.stack(pdf["vector"].to_numpy()), centres.value)
                yield pdf.assign(cell=cell, distance=distance)

    kind = whole.schema["id"].dataType.simpleString()
    rows = whole.mapInPandas(assign, f"id {kind}, vector array<double>, cell int, distance double")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    stats = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).toPandas()
    size, radius = np.zeros(len(centres.value), dtype=np.int64), np.zeros(len(centres.value))
    size[stats["cell"]], radius[stats["cell"]] = stats["n"], stats["radius"]
    parts = np.maximum(-(-size // PART_ROWS), 1)
    dealt = F.array(*[F.lit(int(p)) for p in parts])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.get(dealt, F.col("cell"))).cast("int"))
    return Index(rows.select("cell", "part", "id", "vector"), centres.value, radius, size, parts, int(size.sum()))


def chosen_cells(
    batches: Iterator[pd.DataFrame], shared: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, first: bool
) -> Iterator[pd.DataFrame]:
    """A row (asked, wanted, cell) per visit, in frames of bounded size, of batches of probes."""
    centres, radius, sizes = shared
    for pdf in (part for batch in batches for part in in_parts(batch, AT_ONCE)):
        q = np.stack(pdf["wanted"].to_numpy())
        bound = q @ centres.T + np.sqrt((q**2).sum(axis=1))[:, None] * radius
        bound = np.where(sizes > 0, bound, -np.inf)
        order = np.argsort(-bound, axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1)
        # Cells in front of the one that makes the rows k, and that one.
        early = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(early, order, held - sizes[order] < k, axis=1)
        early &= sizes > 0
        if first:
            chosen = early
        else:
            chosen = ~early & (bound >= pdf["floor"].to_numpy()[:, None] - SLACK * (1 + np.abs(bound))) & (sizes > 0)
        probe, cell = np.nonzero(chosen)
        visits = pd.DataFrame({"probe": probe, "cell": cell.astype(np.int32)})
        # A visit carries its probe's vector, and a probe may look into every cell.
        for some in in_parts(visits, VISITS_AT_ONCE):
            rows = pdf.iloc[some["probe"].to_numpy()]
            yield pd.DataFrame({"asked": rows["asked"].to_numpy(), "wanted": rows["wanted"].to_numpy(), "cell": some["cell"].to_numpy()})


def _visits(probes: DataFrame, index: Index, k: int, first: bool) -> DataFrame:
    """asked, wanted, cell: the cells that each probe looks into, in the first round or the second (with its column floor)."""
    shared = probes.sparkSession.sparkContext.broadcast((index.centres, index.radius, index.sizes))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return chosen_cells(batches, shared.value, k, first)

    kind = probes.schema["asked"].dataType.simpleString()
    return probes.mapInPandas(choose, f"asked {kind}, wanted array<double>, cell int")


def _scored(index: Index, visits: DataFrame, k: int, digits: int, blocks: int) -> DataFrame:
    """asked, id, score: the k best rows of every part of a cell for the probes that look into it."""
    dealt = F.array(*[F.lit(int(p)) for p in index.parts])
    parts = F.explode(F.sequence(F.lit(0), F.get(dealt, F.col("cell")) - 1)).alias("part")
    asked = visits.select("asked", "wanted", "cell", parts, F.pmod(F.xxhash64("asked"), F.lit(blocks)).cast("int").alias("block"))
    held = asked.select(F.col("cell").alias("of_cell"), F.col("block").alias("of_block")).distinct()
    # A cell that no probe looks into is not moved.
    rows = index.rows.withColumnsRenamed({"cell": "of_cell", "part": "of_part"}).join(held, "of_cell")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"asked": [], "id": [], "score": []})
        ids, kind, found = left["id"].to_numpy(), right["asked"].to_numpy().dtype, []
        vectors = np.stack(left["vector"].to_numpy()).T
        for some in in_parts(right, AT_ONCE):
            scores = np.round(np.stack(some["wanted"].to_numpy()) @ vectors, digits)
            for name, line in zip(some["asked"], scores, strict=True):
                # All rows that tie with the kth score are ranked by id.
                near = np.flatnonzero(line >= np.partition(line, -k)[-k]) if len(line) > k else np.arange(len(line))
                best = near[np.lexsort((ids[near], -line[near]))[:k]]
                found.append((np.full(len(best), name, kind), ids[best], line[best]))
        return pd.DataFrame(dict(zip(("asked", "id", "score"), map(np.concatenate, zip(*found)), strict=True)))

    kinds = [df.schema[c].dataType.simpleString() for df, c in ((visits, "asked"), (index.rows, "id"))]
    met = rows.groupBy("of_cell", "of_part", "of_block").cogroup(asked.groupBy("cell", "part", "block")).applyInPandas(score, f"asked {kinds[0]}, id {kinds[1]}, score double")
    return top_per_key(met, ["asked"], [F.desc("score"), F.col("id")], k)


def search(
    index: Index | None, probes: DataFrame, k: int, path: str, probe_id: str = "probe_id", probe: str = "probe", digits: int = 7
) -> tuple[DataFrame, DataFrame]:
    """(probe_id, rank, id, score; probe_id, cells, scored, share): the k best rows per probe, and what was looked at.

    Probes without an id, with an unusable vector or another length than the
    index take no part; each row of probes is to have an id of its own. Ties go
    to the smaller id; scores are rounded before they are ranked. The first
    round's result is kept under path, so that it runs once.
    """
    spark = probes.sparkSession
    kind = probes.schema[probe_id].dataType.simpleString()
    if index is None:
        empty = f"{probe_id} {kind}, rank int, id bigint, score double"
        return spark.createDataFrame([], empty), spark.createDataFrame([], f"{probe_id} {kind}, cells bigint, scored bigint, share double")
    asked = usable(probes, probe_id, probe, index.centres.shape[1]).withColumnsRenamed({"id": "asked", "vector": "wanted"})
    blocks = max(-(-asked.count() // PROBE_ROWS), 1)
    early = _visits(asked, index, k, True)
    best = _scored(index, early, k, digits, blocks)
    best.write.parquet(path)
    best = spark.read.schema(best.schema).parquet(path)
    # Scores are rounded, so a row under the floor by less than a last digit may still tie.
    floor = best.where(F.col("rank") == min(k, index.n)).select("asked", (F.col("score") - 10.0**-digits).alias("floor"))
    late = _visits(asked.join(floor, "asked"), index, k, False)
    both = best.drop("rank").unionByName(_scored(index, late, k, digits, blocks).drop("rank"))
    out = top_per_key(both, ["asked"], [F.desc("score"), F.col("id")], k)
    sizes = F.array(*[F.lit(int(s)) for s in index.sizes])
    seen = early.unionByName(late).groupBy("asked").agg(F.count("*").alias("cells"), F.sum(F.get(sizes, F.col("cell"))).cast("long").alias("scored"))
    seen = seen.withColumn("share", F.col("scored") / index.n)
    return out.select(F.col("asked").alias(probe_id), "rank", "id", "score"), seen.withColumnRenamed("asked", probe_id)
