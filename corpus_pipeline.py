"""Documents filtered, deduplicated, sanitized, mixed and tokenized, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import pii, quality
from tamarack.llm.minhash import near_components
from tamarack.llm.mixing import mix
from tamarack.llm.pieces import round_trip
from tamarack.session import materialize

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. An empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels), out="__score")
    return scored.filter(F.col("__score") >= quality.THRESHOLD).drop("__score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near duplicates.

    Documents without words are in no group and stay; so do rows without doc_id. Rows
    that repeat a doc_id count as one document: the smallest row stays.
    """
    groups = materialize(near_components(docs).select("doc_id", "kept").filter("doc_id IS NOT NULL"), "groups")
    seen = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    seen = materialize(seen.filter("rows > 1 OR NOT kept"), "seen")
    rest = docs.join(seen.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    again = seen.filter("rows > 1 AND kept").select("doc_id")
    if again.isEmpty():
        return rest
    once = docs.join(again, "doc_id", "left_semi").select("doc_id", F.struct(*docs.columns).alias("row"))
    return rest.unionByName(once.groupBy("doc_id").agg(F.min("row").alias("row")).select("row.*"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and what discloses it replaced; n_chars follows the text."""
    clean = pii.sanitize(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often (0 to 2 times) as the words that the mix takes of it come nearest to.

    Documents without words are not taken. Rows that share a doc_id, or have none, go in
    as often as the one of them that goes in most.
    """
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0))
    plan = mix(docs).select("doc_id", copies.cast("int").alias("copies"))
    plan = plan.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
    plan = materialize(plan.filter("__copies > 0"), "plan")
    taken = docs.join(plan, docs["doc_id"].eqNullSafe(plan["__id"]))
    again = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return taken.withColumn("__copy", again).select(*[docs[c] for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_ids, ids and whether the ids decode to the text."""
    return round_trip(docs, TOKENIZER).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("mixing sources", mix_sources),
    ("sentencepiece", tokenize),
]

#: The first stages fit a model and hash signatures, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
