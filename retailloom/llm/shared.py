"""What several operators need from the session: batch bounds, stored tables, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retailloom.session import prepare, scratch_path

# Rows and bytes of an Arrow batch, so that very long texts do not meet in one batch.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """The package's settings, and bounded batches between the JVM and Python."""
    prepare(spark)
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, label: str, partitions: list[str] | None = None, **options: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.options(**options)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for the documents no model may learn from: crc32 of the id as text divisible by ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def components(edges: DataFrame, label: str = "components", rounds: int = 40) -> DataFrame:
    """(node, component) of an undirected graph given as ``a``, ``b``; a component is named by its smallest node.

    Alternates two steps until no edge changes: every node hands its larger
    neighbours to the smallest of its neighbourhood, then its smaller ones. Each
    round is a grouped minimum and a join, both splittable, and is stored once, its state told as it is written.
    Edges that are stars already take one round. Self-edges and repeats do no harm; NULL ends are dropped.
    """
    edges, seen = _with_state(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # An edge and a node give one row each at most, so repeats need not go before the round's end.
        large = large.union(least.where("low < a").select("a", F.col("low").alias("b")))
        floor = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(floor, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        before = seen
        edges, seen = _with_state(small.union(floor.select("a", F.col("low").alias("b"))).distinct(), label)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = stars.select(F.col("component").alias("node")).distinct()
    return stars.withColumnRenamed("a", "node").union(roots.select("node", F.col("node").alias("component")))


def _with_state(edges: DataFrame, label: str) -> tuple[DataFrame, dict]:
    """The edges, stored, and what tells them from others: their number and the sum of their hashes."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashes.alias("s")), label), seen.get
