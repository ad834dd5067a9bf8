"""Prefix trie of conversations, built from their lexicographic order.

Conversations are sorted as sequences of turn fingerprints.  In that order the
members of any trie node are one contiguous run, bounded where the longest
common prefix (LCP) of sorted neighbours drops below the node's depth: going
through LCP edges from the deepest down, each merge of two runs is a branching
node, the classic view of a trie as the union-find forest of its LCP edges.
The sort is Spark's range-partitioned sort; a run may cross partitions, so
nodes are not assembled inside a task but keyed by ``(depth, fingerprint of the
prefix)`` and merged across partitions by one grouping.  Sums over subtrees use
the order itself: a node's subtree is the nodes whose first member lies in its
run, so they are prefix sums along the sort (per partition, plus offsets of the
partitions before; one number per partition reaches the driver).

Fingerprints are two 64-bit XOR sums of hashes of ``(position, role, text)``
over the prefix, so equal prefixes always agree and different ones collide with
a probability of about ``2**-128``.  All work is joins, windows and groupings of
Spark SQL; no task holds more than one conversation's turns or one partition's
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.staging import stage

HEAD_TURNS = 6  # h = crc32(decimal id) mod HEAD_TURNS


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, i, role, text``: turns numbered from 0 by ``turn`` (null first).

    Null roles and texts become empty; equal turn numbers are ordered by role,
    then text, so repeated rows stay, one after the other.  Rows without a
    ``conv_id`` belong to no conversation and are left out.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("i", F.row_number().over(order) - 1).drop("turn")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ids, turns)`` of the rebuilt conversations.

    Conversation ``c`` becomes the first ``h`` turns of conversation
    ``c - c % 100`` (all if fewer, none if absent) followed by its own turns
    after its first ``h``, with ``h = crc32(str(c)) % 6``.  ``ids`` has one row
    per conversation (``conv_id, n_turns``), also for those left without
    turns; ``turns`` has ``conv_id, i, role, text``.
    """
    turns = ordered_turns(conversations)
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 100).alias("base_id"))
    sizes = ids.select(F.col("conv_id").alias("base_id"), F.col("own").alias("base_len"))
    ids = ids.join(sizes, "base_id", "left").withColumn("taken", F.least("h", F.coalesce("base_len", F.lit(0))))
    heads = turns.where(F.col("i") < HEAD_TURNS - 1).withColumnRenamed("conv_id", "base_id") \
        .join(ids.select("base_id", "conv_id", "h"), "base_id").where(F.col("i") < F.col("h")) \
        .select("conv_id", "i", "role", "text")
    tails = turns.join(ids.select("conv_id", "h", "taken"), "conv_id").where(F.col("i") >= F.col("h")) \
        .select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("i"), "role", "text")
    lengths = ids.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return lengths, heads.unionByName(tails)


def _running(rows: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the sum of ``value`` over rows up to this one in ``order``.

    ``order`` comes from ``monotonically_increasing_id`` after a sort, so its
    upper bits name the partition: sums run per partition, then each adds the
    totals of the partitions before (a table of one row per partition).
    """
    part = F.shiftright(order, 33)
    rows = rows.withColumn("_part", part)
    inside = rows.withColumn("_in", F.sum(value).over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    totals = rows.groupBy("_part").agg(F.sum(value).alias("_total"))
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_total").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return inside.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_in") + F.col("_before")).drop("_part", "_in", "_before")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node of the rebuilt conversations.

    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null
    at the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in
    the subtree, itself included), ``saved_tokens`` (over the subtree, each
    node's ``(n_convs - 1) *`` code points of its last text; the root's text is
    empty) and ``ends_sha256`` (SHA-256 of the ascending ids of members with
    exactly ``depth`` turns, comma-joined; none: the hash of ``''``).

    The root exists whenever some row has a ``conv_id``; an empty table gives no
    nodes.  Other columns are not read.
    """
    lengths, turns = rebuild(conversations)
    turns = turns.select(
        "conv_id", "i", F.length("text").cast("long").alias("chars"), F.xxhash64("role", "text").alias("t"),
        F.xxhash64("i", "role", "text").alias("u1"), F.xxhash64("text", "i", "role", F.lit(1)).alias("u2"))
    upto = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("h1", F.bit_xor("u1").over(upto)).withColumn("h2", F.bit_xor("u2").over(upto))
    turns = stage(turns, "trie-turns")

    # Sort conversations as sequences of turn hashes; the id breaks ties between equal sequences.
    seqs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", "t"))).alias("seq"))
    convs = lengths.join(seqs, "conv_id", "left").select(
        "conv_id", "n_turns", F.coalesce(F.transform("seq", lambda x: x["t"]), F.array().cast("array<bigint>")).alias("seq"))
    ranked = stage(convs.orderBy("seq", "conv_id").withColumn("rank", F.monotonically_increasing_id()).drop("seq"), "trie-ranks")

    # Every prefix of every conversation, the root (depth 0) included.
    root = ranked.select("conv_id", "rank", "n_turns", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("h1"),
                         F.lit(0).cast("long").alias("h2"), F.lit(None).cast("long").alias("p1"),
                         F.lit(None).cast("long").alias("p2"), F.lit(0).cast("long").alias("chars"))
    back = Window.partitionBy("conv_id").orderBy("i")
    deeper = turns.select("conv_id", (F.col("i") + 1).alias("depth"), "h1", "h2", "chars",
                          F.coalesce(F.lag("h1").over(back), F.lit(0)).alias("p1"),
                          F.coalesce(F.lag("h2").over(back), F.lit(0)).alias("p2")).join(ranked, "conv_id")
    prefixes = root.unionByName(deeper.select(*root.columns))
    nodes = prefixes.groupBy("depth", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.max("chars").alias("chars"),
        F.sort_array(F.collect_list(F.when(F.col("n_turns") == F.col("depth"), F.col("conv_id")))).alias("ends"))
    nodes = stage(nodes, "trie-nodes")

    children = nodes.where(F.col("depth") > 0).groupBy(F.col("depth") - 1, "p1", "p2").agg(F.count("*").alias("n_children")) \
        .toDF("depth", "h1", "h2", "n_children")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, ["depth", "h1", "h2"], "left").join(parents, ["depth", "p1", "p2"], "left") \
        .withColumn("n_children", F.coalesce("n_children", F.lit(0))) \
        .withColumn("w_saved", (F.col("n_convs") - 1) * F.col("chars")) \
        .withColumn("w_leaf", (F.col("n_children") == 0).cast("long"))
    nodes = stage(nodes, "trie-linked")

    # Subtree sums: nodes first met at the same rank and at least as deep, then all first met inside (lo, hi].
    chain = Window.partitionBy("lo").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumn("own_saved", F.sum("w_saved").over(chain)).withColumn("own_leaves", F.sum("w_leaf").over(chain))
    per_rank = nodes.groupBy(F.col("lo").alias("rank")).agg(F.sum("w_saved").alias("s"), F.sum("w_leaf").alias("l"))
    sums = ranked.select("rank").join(per_rank, "rank", "left").fillna(0, ["s", "l"])
    sums = stage(_running(_running(sums, "rank", "s", "ps"), "rank", "l", "pl").select("rank", "ps", "pl"), "trie-sums")
    at = lambda side: sums.select(F.col("rank").alias(side), F.col("ps").alias(f"ps_{side}"), F.col("pl").alias(f"pl_{side}"))
    nodes = nodes.join(at("lo"), "lo").join(at("hi"), "hi")
    return nodes.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        (F.col("own_leaves") + F.col("pl_hi") - F.col("pl_lo")).cast("long").alias("n_leaves"),
        (F.col("own_saved") + F.col("ps_hi") - F.col("ps_lo")).cast("long").alias("saved_tokens"),
        F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256).alias("ends_sha256"))
