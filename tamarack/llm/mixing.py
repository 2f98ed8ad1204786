"""Mix sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Every source has a word budget. Its documents, in a seeded order and twice over, are
a line of words that is cut into blocks of equal size. A source's j-th block has the
quotient target / (2j - 1); the blocks with the highest quotients, down to half a
block, are allocated, which gives every source a whole number of blocks. They go round the
shards, which gives every shard a quota of each source. A shard holds a run of the source's
line and selects its quota of blocks from a seeded start, at even distances, so what a document
gives is a matter of arithmetic and no block is ever a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.operators.joins import join_lookup
from tamarack.operators.ordering import row_index, running_total
from tamarack.session import materialize

WEIGHTS = (5, 2, 1)  # of the sources in the order of their names, repeating
SHARE = 1.5  # of all words
REPEATS = 2  # times that a document's words can be taken
BLOCK = 32  # words at most; small sources ask for smaller ones
SHARDS = 16
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Runs of characters other than blank and the control characters 9 to 13; 0 for null."""
    parts = F.split(text, r"[\x20\x09-\x0D]+", -1)
    edges = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    return F.coalesce(F.greatest(F.size(parts).cast("long") - edges, F.lit(0).cast("long")), F.lit(0).cast("long"))


def seeded(value: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))).cast("binary"))


def _source_key(source: str) -> Column:
    """A key that is never null and sorts as the source does, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The word budget of every source: source_key, source_size, target.

    ``sizes`` has source_key and size. Budgets are the weights' shares of ``share``
    times all words; none exceeds ``repeats`` times its source, and what it would
    exceed that by goes to the others by weight. That is one water level: the target
    is the level times the weight, up to the cap.
    """
    sums = materialize(sizes.groupBy("source_key").agg(F.sum("size").alias("source_size")), "sources")
    placed = row_index(sums, ["source_key"], "__at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__at") % len(weights) + 1).cast("int"))
    caps = placed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    caps = caps.drop("__at").withColumn("ratio", F.col("cap") / F.col("weight"))
    order = ["ratio", "source_key"]
    run = running_total(caps, order, "cap", name="cap_before", total="cap_total")
    run = materialize(running_total(run, order, "weight", name="weight_before", total="weight_total"), "caps")
    # The level if every source with a smaller ratio is capped; the first that holds is the level.
    wanted = F.col("cap_total") * F.lit(share / repeats)
    level = (wanted - F.col("cap_before")) / (F.col("weight_total") - F.col("weight_before"))
    holds = run.withColumn("level", level).filter(F.col("level") <= F.col("ratio") * (1 + 1e-12))
    first = holds.agg(F.min_by("level", F.struct("ratio", "source_key")).alias("level"))
    return run.crossJoin(F.broadcast(first)).select(  # one row
        "source_key", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target")
    )


def block_size(budgets: DataFrame, most: int = BLOCK) -> int:
    """Words of a block: ``most``, or an eighth of the smallest target above 0, so that every source comes near its own."""
    least = budgets.filter("target > 0").agg(F.min("target")).first()[0]
    return most if least is None else max(1, min(most, int(least // 8)))


def quotas(budgets: DataFrame, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """Add to every source its blocks on the line and those allocated to it.

    A quotient target / (2j - 1) reaches half a block for the first
    round(target / block) numbers j: these are the blocks with the highest quotients
    of all sources.
    """
    blocks = F.ceil(F.col("source_size") * repeats / F.lit(float(block))).cast("long")
    won = F.floor(F.col("target") / F.lit(float(block)) + F.lit(0.5)).cast("long")
    return budgets.withColumn("blocks", blocks).withColumn("quota", F.least(won, "blocks"))


def shard_quotas(allocated: DataFrame, shards: int) -> DataFrame:
    """Blocks of every source in every shard: source_key, shard, blocks.

    The allocated blocks of all sources, one source after the other, go round the
    shards, so shards differ by one block at most, and so does a source between them.
    """
    run = running_total(allocated.select("source_key", "quota"), ["source_key"], "quota", name="before")
    shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    lag = F.pmod(F.col("shard") - F.col("before"), F.lit(shards))
    return (
        run.withColumn("shard", shard)
        .withColumn("blocks", F.floor((F.col("quota") - lag + F.lit(shards - 1)) / F.lit(shards)).cast("long"))
        .select("source_key", "shard", F.greatest("blocks", F.lit(0).cast("long")).alias("blocks"))
    )


def selections(plan: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Add ``shards`` to every source: for each the first block, the blocks, its quota, the quota before it, and a seeded start.

    Blocks that are not allocated are dealt evenly too, so a shard has at least the blocks of its quota.
    """
    quota = shard_quotas(plan.select("source_key", "quota"), shards)
    rest = plan.select("source_key", (F.col("blocks") - F.col("quota")).alias("quota"))
    others = shard_quotas(rest, shards).withColumnRenamed("blocks", "others")
    # Bounded: a row per shard.
    earlier = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    key = F.concat_ws(":", F.col("shard").cast("string"), F.substring("source_key", 2, 1 << 30))
    start = F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("long")
    each = quota.join(others, ["source_key", "shard"]).withColumn("n", F.col("blocks") + F.col("others"))
    each = each.select(
        "source_key", "shard", "n", F.col("blocks").alias("quota"),
        F.coalesce(F.sum("n").over(earlier), zero).alias("first"), F.coalesce(F.sum("blocks").over(earlier), zero).alias("before"),
        F.when(F.col("n") > 0, start % F.col("n")).otherwise(zero).alias("start"),
    )
    listed = F.array_sort(F.collect_list(F.struct("shard", "first", "n", "quota", "before", "start")))
    return plan.join(each.groupBy("source_key").agg(listed.alias("shards")), "source_key")


def selected(words: Column, shards: Column, block: int) -> Column:
    """How many of the first ``words`` words of a source's line lie in selected blocks.

    Of a shard's n blocks the b-th is selected if (b + start) * quota / n passes a whole number.
    """

    def upto(shard: Column, blocks: Column) -> Column:
        """Selected blocks among the shard's first ``blocks``."""
        product = (blocks + shard["start"]).cast("decimal(19,0)") * shard["quota"].cast("decimal(19,0)")
        skipped = shard["start"].cast("decimal(19,0)") * shard["quota"].cast("decimal(19,0)")
        n = shard["n"].cast("decimal(19,0)")
        return F.call_function("div", product, n) - F.call_function("div", skipped, n)

    at = F.floor(words / block).cast("long")
    own = F.filter(shards, lambda s: (s["first"] <= at) & (at < s["first"] + s["n"]))

    def count(s: Column) -> Column:
        before, after = upto(s, at - s["first"]), upto(s, at - s["first"] + 1)
        return (s["before"] + before) * block + (after - before) * (words - at * block)

    total = F.aggregate(shards, F.lit(0).cast("long"), lambda sum_, s: sum_ + s["quota"]) * block
    return F.when(F.size(own) > 0, F.get(F.transform(own, count), 0)).otherwise(total)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block: int = BLOCK,
    seed: str = SEED,
    shards: int = SHARDS,
) -> DataFrame:
    """Words that the mix takes of every document: ``key``, source_key, size, source_size, target, taken.

    ``docs`` has ``key``, source and text. Sources are weighed in the order of their
    names, null last; a null text has no words. One row per input row: repeated rows
    are documents of their own, other columns are ignored, a null key sorts first.
    Only numbers are shuffled, never texts. Reruns agree.
    """
    sizes = docs.select(key, _source_key("source").alias("source_key"), n_words(F.col("text")).alias("size"))
    sizes = materialize(sizes, "sizes")
    budgets = materialize(targets(sizes, weights, share, repeats), "targets")
    block = block_size(budgets, block)
    plan = materialize(selections(quotas(budgets, block, repeats), shards, seed), "quotas")
    lined = running_total(
        sizes.withColumn("__order", seeded(F.col(key), seed)),
        ["__order", key, "size"],
        "size",
        by=["source_key"],
        name="__at",
        total="__total",
    ).drop("__order", "__total")
    lined = join_lookup(lined, plan.select("source_key", "source_size", "target", "shards"), ["source_key"])

    def passed(p: int) -> Column:
        at = F.col("__at") + F.col("source_size") * p
        return selected(at + F.col("size"), F.col("shards"), block) - selected(at, F.col("shards"), block)

    taken = sum((passed(p) for p in range(repeats)), F.lit(0).cast("long"))
    return lined.select(key, "source_key", "size", "source_size", "target", taken.cast("long").alias("taken"))
