r"""Prefix trie of conversations by composable fingerprints.

Every conversation c is rebuilt from the first turns of another one, its base,
and its own later turns. No rebuilt text is made. The fingerprint of a sequence
of turns t_1 .. t_n is the pair (S, n) with

    S = t_1 + t_2 B + .. + t_n B^(n - 1)   mod 2^31 - 1

for three bases B at once. Such pairs form a monoid: (S, n)(T, m) is
(S + B^n T, n + m), and (1 / B)^n takes a head off again. So the fingerprints
of all prefixes come from one prefix scan over the original turns, and those of
rebuilt conversations from products of a base's head and a suffix of the own
turns.

Rebuilt prefixes with equal fingerprints are one node. That is verified, not
trusted: a turn is referred to by two hashes of its role and text, which are
shown to stand for one content each, and all members of a node must refer to
the same last turn and the same parent; by induction over the depth their
sequences are then equal. If a check fails, all is done again with other bases
and seeds.

Totals over subtrees need no pass per level. The smallest member of a node owns
it, so the nodes of an owner are a stretch of one path; sums along a path are
running sums, and the paths, which form a much flatter tree, are added up by
pointer doubling in log2(height) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.keyed import skew_join
from meterlake.llm.common import stored

PRIME = 2**31 - 1
LANES = 3
HEADS = 9  # a head has fewer turns than this
EVERY = 5
COPIES_A_ROW = 4096
BLOCK_BITS = 12  # running sums along a path go by blocks of 4096 nodes
IDS_A_ROW = 4096
ATTEMPTS = 4

AFTER = [f"a{i}" for i in range(LANES)]
BEFORE = [f"b{i}" for i in range(LANES)]
NODE = ["depth", *AFTER]


def bases(attempt: int) -> list[int]:
    """The lanes' bases: odd multiples of a golden ratio, as the attempt goes on."""
    return [2 + (0x9E3779B97F4A7C15 * (LANES * attempt + lane + 1) >> 16) % (PRIME - 2) for lane in range(LANES)]


def power(base: int, exponent: Column, bits: int = 32) -> Column:
    """base ^ exponent mod PRIME, bit by bit."""
    out = F.lit(1).cast("long")
    for bit in range(bits):
        out = out * (F.shiftright(exponent, bit).bitwiseAND(F.lit(1)) * (base - 1) + 1) % PRIME
        base = base * base % PRIME
    return out


# --- turns --------------------------------------------------------------------


def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(seed), role, text).alias("k1"), F.xxhash64(F.lit(seed + 1), text, role).alias("k2"),
        F.octet_length(text).cast("long").alias("n_bytes"), role.alias("role"), text.alias("text"),
    )


def references_hold(turns: DataFrame) -> bool:
    """Whether every pair of hashes stands for one role and text."""
    content = F.struct("role", "text")
    each = turns.groupBy("k1", "k2").agg(F.min(content).alias("least"), F.max(content).alias("most"))
    return each.where("least <> most").isEmpty()


def places(turns: DataFrame, of: list[int]) -> DataFrame:
    """conv_id, pos (from 1), k1, k2, n_bytes, and the fingerprints before and after each turn.

    The order is by turn (null first), then hashes. Turns are sorted over the
    whole cluster by ranges, so a conversation may span many tasks: each
    scans its stretch, and the stretches of a conversation are composed.
    """
    spark = turns.sparkSession
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2"), F.col("chunk")]
    once = turns.groupBy("conv_id", "turn", "k1", "k2", "n_bytes").agg(F.count("*").alias("copies"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_A_ROW))).alias("chunk")
    once = once.select("*", chunk).withColumn("copies", F.least(F.lit(COPIES_A_ROW), F.col("copies") - F.col("chunk") * COPIES_A_ROW))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = once.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("stretch", F.spark_partition_id())
    dealt = stored(dealt, "turn-order")
    rows = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    within = Window.partitionBy("conv_id", "stretch").orderBy(*order[1:], "copy")
    rows = rows.withColumn("i", F.row_number().over(within).cast("long"))
    values = [F.pmod(F.col("k1"), F.lit(PRIME)), F.pmod(F.col("k2"), F.lit(PRIME)), F.pmod(F.xxhash64("k1", "k2"), F.lit(PRIME))]
    rows = rows.withColumns({f"t{x}": v * power(of[x], F.col("i") - 1) % PRIME for x, v in enumerate(values)})
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"s{x}": F.sum(f"t{x}").over(upto) for x in range(LANES)})
    rows = rows.select("conv_id", "stretch", "i", "k1", "k2", "n_bytes", *[f"t{x}" for x in range(LANES)], *[f"s{x}" for x in range(LANES)])
    rows = stored(rows, "turn-scan")
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("size"), *[(F.sum(f"t{x}") % PRIME).alias(f"e{x}") for x in range(LANES)])
    ends = ends.withColumn("shift", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    ends = ends.withColumns({f"p{x}": power(of[x], F.col("shift")) for x in range(LANES)})
    ends = ends.withColumns({f"o{x}": F.coalesce(F.sum(F.col(f"p{x}") * F.col(f"e{x}") % PRIME).over(earlier), F.lit(0)) % PRIME for x in range(LANES)})
    ends = ends.select("conv_id", "stretch", "shift", *[f"{c}{x}" for c in "po" for x in range(LANES)])
    rows = skew_join(rows, ends, ["conv_id", "stretch"], "inner")
    whole = lambda x, s: (F.col(f"o{x}") + F.col(f"p{x}") * (s % PRIME)) % PRIME
    return rows.select(
        "conv_id", (F.col("shift") + F.col("i")).alias("pos"), "k1", "k2", "n_bytes",
        *[whole(x, F.col(f"s{x}") - F.col(f"t{x}")).alias(f"b{x}") for x in range(LANES)],
        *[whole(x, F.col(f"s{x}")).alias(f"a{x}") for x in range(LANES)],
    )


# --- rebuilt conversations ------------------------------------------------------


def heads(placed: DataFrame, every: int, most: int) -> DataFrame:
    """One row per conversation: n turns, its own and its base's first turns, h, and the turns it takes (taken)."""
    first = F.when(F.col("pos") < most, F.struct("pos", "k1", "k2", "n_bytes", *BEFORE, *AFTER))
    each = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), F.array_sort(F.collect_list(first)).alias("own"))
    base = each.select(F.col("conv_id").alias("base"), F.col("own").alias("head"))
    each = each.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    each = each.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most)
    each = each.join(base, "base", "left")
    head = F.slice(F.coalesce("head", F.expr("slice(own, 1, 0)")), F.lit(1), F.col("h").cast("int"))
    each = each.withColumn("head", head).withColumn("taken", F.size("head").cast("long"))
    return each.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h")))


def steps(placed: DataFrame, each: DataFrame, of: list[int], most: int) -> DataFrame:
    """conv_id, depth, last, k1, k2, n_bytes, fingerprints before and after: a row per rebuilt turn."""
    columns = ["conv_id", "depth", "last", "k1", "k2", "n_bytes", *BEFORE, *AFTER]
    taken = each.select("conv_id", "length", F.explode("head").alias("x")).select("conv_id", "length", "x.*")
    taken = taken.withColumn("depth", F.col("pos")).withColumn("last", F.col("pos") == F.col("length")).select(*columns)
    end = lambda side, size, x: F.coalesce(F.expr(f"get({side}, cast({size} - 1 AS int)).a{x}"), F.lit(0).cast("long"))
    known = each.select(
        "conv_id", "h", "taken", "length",
        *[end("head", "taken", x).alias(f"f{x}") for x in range(LANES)], *[end("own", "h", x).alias(f"g{x}") for x in range(LANES)],
    )
    rows = skew_join(placed, known, ["conv_id"], "inner").where("pos > h")

    def moved(x: int, s: str) -> Column:
        back = pow(of[x], PRIME - 2, PRIME)
        factors = F.array(*[F.lit(pow(back, e, PRIME)).cast("long") for e in range(most)])
        factor = F.get(factors, (F.col("h") - F.col("taken")).cast("int"))
        return (F.col(f"f{x}") + F.pmod(F.col(f"{s}{x}") - F.col(f"g{x}"), F.lit(PRIME)) * factor) % PRIME

    rows = rows.withColumn("depth", F.col("taken") + F.col("pos") - F.col("h"))
    rows = rows.withColumns({f"{s}{x}": moved(x, s) for s in "ba" for x in range(LANES)})
    return taken.unionByName(rows.withColumn("last", F.col("depth") == F.col("length")).select(*columns))


# --- nodes ------------------------------------------------------------------------


def nodes_of(rows: DataFrame, each: DataFrame) -> DataFrame:
    """The nodes, each with its fingerprint, parent's fingerprint and smallest member; mixed if members differ."""
    proof = [*BEFORE, "k1", "k2"]
    found = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        *[F.min(c).alias(c) for c in proof], *[F.max(c).alias(f"{c}_most") for c in proof],
    )
    mixed = F.lit(False)
    for c in proof:
        mixed = mixed | (F.col(c) != F.col(f"{c}_most"))
    found = found.select(*NODE, *BEFORE, "conv_id", "n_convs", "n_bytes", mixed.alias("mixed"))
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = each.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), *[zero.alias(c) for c in AFTER], *[null.alias(c) for c in BEFORE], "conv_id", "n_convs",
        zero.alias("n_bytes"), F.lit(False).alias("mixed"),
    )
    return found.unionByName(root)


def linked(nodes: DataFrame) -> DataFrame:
    """Nodes with parent_conv_id, n_children, value and leaf."""
    key = ["_up", *BEFORE]
    below = nodes.withColumn("_up", F.col("depth") - 1)
    above = nodes.select(F.col("depth").alias("_up"), *[F.col(a).alias(b) for a, b in zip(AFTER, BEFORE, strict=True)], F.col("conv_id").alias("parent_conv_id"))
    out = skew_join(below.where("depth > 0"), above, key, "inner").drop("_up")
    out = out.unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    children = below.where("depth > 0").groupBy(*key).agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed(dict(zip(key, NODE, strict=True)))
    out = out.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    value = (F.col("n_convs") - 1) * F.col("n_bytes")
    return out.select(*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", value.alias("value"), (F.col("n_children") == 0).cast("long").alias("leaf"))


def path_totals(tree: DataFrame) -> DataFrame:
    """owner, up (the path it hangs on; null for the root's), at (the depth there), value and leaf summed over all that hangs on it.

    After k rounds a path has the sums of the paths up to 2^k - 1 steps below
    it and a pointer 2^k steps up.
    """
    tops = tree.where("parent_conv_id IS NULL OR parent_conv_id <> conv_id")
    tops = tops.select("conv_id", F.col("parent_conv_id").alias("up"), (F.col("depth") - 1).alias("at"))
    sums = tree.groupBy("conv_id").agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    state = stored(tops.join(sums, "conv_id").withColumn("far", F.col("up")), "paths")
    while not state.where("far IS NOT NULL").isEmpty():
        going = state.where("far IS NOT NULL")
        given = going.groupBy(F.col("far").alias("conv_id")).agg(F.sum("value").alias("more"), F.sum("leaf").alias("leaves"))
        jumps = state.select(F.col("conv_id").alias("far"), F.col("far").alias("farther"))
        going = skew_join(going, jumps, ["far"], "inner").drop("far").withColumnRenamed("farther", "far")
        state = going.unionByName(state.where("far IS NULL")).join(given, "conv_id", "left")
        state = state.withColumn("value", F.col("value") + F.coalesce("more", F.lit(0)))
        state = stored(state.withColumn("leaf", F.col("leaf") + F.coalesce("leaves", F.lit(0))).drop("more", "leaves"), "paths")
    return state.drop("far")


def subtree_sums(tree: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes with n_leaves and saved_tokens: from a node to the end of its path, with all that hangs there."""
    hung = totals.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth"))
    hung = hung.agg(F.sum("value").alias("more"), F.sum("leaf").alias("leaves"))
    rows = tree.join(hung, ["conv_id", "depth"], "left")
    rows = rows.withColumn("value", F.col("value") + F.coalesce("more", F.lit(0))).withColumn("leaf", F.col("leaf") + F.coalesce("leaves", F.lit(0)))
    rows = rows.drop("more", "leaves").withColumn("block", F.shiftright("depth", BLOCK_BITS))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"later_{c}") for c in ("value", "leaf")])
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("in_value", F.sum("value").over(within)).withColumn("in_leaf", F.sum("leaf").over(within))
    rows = rows.join(blocks, ["conv_id", "block"])
    return rows.withColumn("saved_tokens", F.col("in_value") + F.col("later_value")).withColumn("n_leaves", F.col("in_leaf") + F.col("later_leaf"))


# --- members that end at a node ---------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) rows to rows of (node, first id, ids joined by commas), IDS_A_ROW ids at most."""
    node, ids, names = None, [], [*NODE, "first", "ids"]

    def row() -> pa.RecordBatch:
        values = [*node, ids[0], ",".join(map(str, ids))]
        return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))])

    for batch in batches:
        for *at, conv_id in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if node is not None and (at != node or len(ids) == IDS_A_ROW):
                yield row()
                ids = []
            node = at
            ids.append(conv_id)
    if ids:
        yield row()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of _listed to one digest per node, which reads its rows one by one."""
    node, digest, names = None, None, [*NODE, "ends_sha256"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, [*node, digest.hexdigest()], strict=True))])

    for batch in batches:
        for *at, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if at != node:
                if node is not None:
                    yield row()
                node, digest = at, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if node is not None:
        yield row()


def ends_of(rows: DataFrame, each: DataFrame) -> DataFrame:
    """Node and SHA-256 of the ids of the conversations that end there.

    The ids are sorted and joined by ranges over the cluster; only a digest
    itself, which no one can split, is one task's pass over its node's rows.
    """
    zero = F.lit(0).cast("long")
    ends = rows.where("last").select(*NODE, "conv_id")
    ends = ends.unionByName(each.where("length = 0").select(zero.alias("depth"), *[zero.alias(c) for c in AFTER], "conv_id"))
    kinds = ", ".join(f"{c} bigint" for c in NODE)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = ends.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    ids = ends.mapInArrow(_listed, f"{kinds}, first bigint, ids string")
    ids = ids.repartition(n, *NODE).sortWithinPartitions(*NODE, "first")
    return ids.mapInArrow(_digests, f"{kinds}, ends_sha256 string")


def _built(conversations: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    for attempt in range(ATTEMPTS):
        of, turns = bases(attempt), _turns(conversations, 2 * attempt)
        if not references_hold(turns):
            continue
        placed = stored(places(turns, of), "turn-places")
        each = stored(heads(placed, every, most), "conversation-heads")
        rows = stored(steps(placed, each, of, most), "rebuilt-turns")
        nodes = stored(nodes_of(rows, each), "trie-nodes")
        if nodes.where("mixed").isEmpty():
            return rows, each, nodes
    raise RuntimeError("no bases without collisions")


def trie(conversations: DataFrame, every: int = EVERY, most: int = HEADS) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c takes the first h = crc32(c) % most turns of conversation
    c - c % every (the remainder has the sign of c) and goes on with its own
    turns after its first h. Rows without conv_id have no part. Turns with
    one number, repeated rows included, are all turns, in the order of a hash of
    role and text. Null role or text is empty. An empty table has no rows, not
    even a root. Other columns are not read.
    """
    rows, each, nodes = _built(conversations, every, most)
    tree = stored(linked(nodes), "trie")
    sums = subtree_sums(tree, path_totals(tree))
    out = sums.join(ends_of(rows, each), NODE, "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
