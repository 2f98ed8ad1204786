"""Shards of equal size that keep linked documents together: balanced label propagation.

Nodes are joined to hubs (what linked documents share), never to each other, so a
group of any size costs one row per member. A node's label is its shard. In every
round each node learns by joins how many rows of its hubs' nodes lie in each shard
and asks to move to the shard with most of them; a shard admits the largest requests
that its quota has room for. At the end each shard takes exactly its quota: rows
beyond it, of the smallest groups first, and rows without links fill what is free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.ordering import row_index, running_total
from tamarack.session import materialize

SHARDS = 16
ROUNDS = 6


def propagate(nodes: DataFrame, links: DataFrame, capacity: int, rounds: int = ROUNDS, slack: float = 1.0) -> DataFrame:
    """Move the labels of ``nodes`` (node, size, label) along ``links`` (node, hub).

    A node asks for the shard with most rows of its hubs' nodes (of equal ones the first)
    among those that have room for it, if that is better than its own. A shard holds
    ``capacity`` rows, times 1 + ``slack`` in the first round, which falls to 1 in the
    last; it admits requests as long as they fit beside what it holds now. Nobody is
    turned out, so a shard can end above ``capacity`` unless ``slack`` is 0. Ends when
    nobody moves any more, or after ``rounds``. Nodes without links keep their label.
    """
    nodes = materialize(nodes, "nodes")
    for left in reversed(range(rounds)):
        room = int(capacity * (1 + slack * left / max(1, rounds - 1)))
        loads = nodes.groupBy("label").agg(F.sum("size").alias("__load"))  # a row per shard
        votes = links.join(nodes, "node").groupBy("hub", "label").agg(F.sum("size").alias("votes"))
        heard = links.join(votes, "hub").groupBy("node", "label").agg(F.sum("votes").alias("votes"))
        own = nodes.select("node", "size", F.col("label").alias("own"))
        heard = heard.join(own, "node").join(F.broadcast(loads), "label", "left")
        fits = (F.col("label") == F.col("own")) | (F.coalesce("__load", F.lit(0)) + F.col("size") <= room)
        rank = F.struct("votes", -F.col("label"))
        asks = heard.filter(fits).groupBy("node").agg(
            F.max_by("label", rank).alias("wanted"),
            F.max("votes").alias("votes"),
            F.first("own").alias("own"),
            F.first("size").alias("size"),
        )
        asks = asks.filter(F.col("wanted") != F.col("own"))
        asks = asks.select("node", "size", "wanted", (-F.col("votes")).alias("__first"), F.xxhash64("node").alias("__any"))
        queued = running_total(asks, ["__first", "__any", "size"], "size", by=["wanted"], name="__ahead", total="__all")
        queued = queued.join(F.broadcast(loads.withColumnRenamed("label", "wanted")), "wanted", "left")
        admitted = F.coalesce("__load", F.lit(0)) + F.col("__ahead") + F.col("size") <= room
        moves = materialize(queued.filter(admitted).select("node", "wanted"), "moves")
        if moves.isEmpty():
            if room == capacity:
                break
            continue
        moved = nodes.join(moves, "node", "left")
        nodes = materialize(moved.select("node", "size", F.coalesce("wanted", "label").alias("label")), "nodes")
    return nodes.select("node", "label")


def _quota(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _listed(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def shard_rows(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, seed: int = 11) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    The law is ``rows``: the shards' row counts are at most one apart, the first shards
    have the extra rows. ``size`` is the text's UTF-8 bytes (null: 0) plus 1; ``slot``
    counts a shard's rows from 0 without gaps; ``grown_shard`` is null. Documents of
    equal text are linked and stay together as far as the quotas allow; null texts are
    linked with nothing, empty ones with each other. Repeated rows are rows of their
    own, a null doc_id stays, other columns are ignored. Texts are not shuffled.
    """
    home = F.pmod(F.xxhash64("doc_id", "hub", F.lit(seed)), F.lit(shards)).cast("int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("hub"),
    ).withColumn("home", home)
    rows = materialize(rows, "rows")
    total = rows.count()
    quota = _quota(total, shards)

    # Rows of one hub that start in one shard move together: a node.
    cells = rows.filter("hub IS NOT NULL").groupBy("hub", "home").agg(F.count(F.lit(1)).alias("size"))
    groups = cells.groupBy("hub").agg(F.sum("size").alias("members")).filter("members > 1")
    nodes = materialize(
        cells.join(groups, "hub").select(F.struct("hub", "home").alias("node"), "hub", "members", "size", F.col("home").alias("label")),
        "cells",
    )
    capacity = min(quota)
    labels = propagate(nodes.select("node", "size", "label"), nodes.select("node", "hub"), capacity, rounds)
    placed = nodes.join(labels.withColumnRenamed("label", "shard"), "node").select("node.*", "members", "shard")
    told = rows.join(placed, ["hub", "home"], "left")
    told = materialize(told.withColumn("__small", -F.coalesce("members", F.lit(1))).drop("home", "members"), "told")

    linked = told.filter("shard IS NOT NULL").withColumn("__one", F.lit(1))
    order = ["__small", "hub", "doc_id", "text_crc32", "size"]
    linked = materialize(running_total(linked, order, "__one", by=["shard"], name="slot").drop("__one", "total"), "linked")
    mine = F.element_at(_listed(quota), F.col("shard") + 1)
    kept = linked.filter(F.col("slot") < mine)
    held = dict(kept.groupBy("shard").count().collect())  # a number per shard
    free = [q - held.get(s, 0) for s, q in enumerate(quota)]
    before = [sum(free[:s]) for s in range(shards + 1)]

    # Rows over a quota come first and stay beside each other; rows without links follow.
    over = linked.filter(F.col("slot") >= mine).select(*told.columns)
    loose = told.filter("shard IS NULL").withColumn("hub", F.xxhash64("doc_id", F.lit(seed)))
    loose = row_index(over.unionByName(loose), order, "__place")
    ends = _listed(before[1:])
    target = F.size(F.filter(ends, lambda end: end <= F.col("__place"))).cast("int")
    loose = loose.withColumn("shard", target)
    gap = F.element_at(_listed([held.get(s, 0) - before[s] for s in range(shards)]), F.col("shard") + 1)
    loose = loose.withColumn("slot", F.col("__place") + gap)

    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    out = kept.select(*columns).unionByName(loose.select(*columns))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
