"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Each source is a stream: its documents one after another in an order shuffled by
hash, repeated as often as needed. Slot i of the schedule is the golden-ratio point
frac(i * phi); the source whose share of the cumulative targets holds the point
gets the slot, and its r-th slot takes the r-th block of its stream. All native:
positions in streams and ranks of slots are two-level running sums, so no source
is gathered in one task.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored

# What counts as a word, and the weights of sources in order.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3

_CHUNK = 1 << 16
_LOW = 1 << 20


def _golden(factor: int) -> float:
    getcontext().prec = 60
    value = (Decimal(5).sqrt() - 1) / 2 * factor
    return float(value - int(value))


def point(i):
    """frac(i * golden ratio), from the two halves of i so that large i keep their digits."""
    return F.pmod((i % _LOW) * F.lit(_golden(1)) + F.floor(i / _LOW) * F.lit(_golden(_LOW)), F.lit(1.0))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Adds ``sid`` (rank by code point, NULL last), ``weight`` and ``target`` to (source, source_size).

    The words of all sources are shared by weight; a source stops at ``repeats``
    times its size and its excess is shared among the others. In order of
    size / weight the sources that stop are a prefix, found with running sums.
    One row per source: the windows over all sources are as small as their number.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("sid", F.row_number().over(place).cast("long"))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    all_rows = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("free", F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(all_rows))
    return ranked.select("source", "sid", "source_size", F.least("cap", F.coalesce(F.col("free") * F.col("weight"), F.col("cap"))).alias("target"))


def stream_key(doc_id: Column, seed: int = 1) -> Column:
    """What orders the documents of a source's stream, before doc_id and size."""
    return F.md5(F.concat_ws(":", F.lit(seed), doc_id))


def streams(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Adds ``sid`` and ``offset``, a document's place in its source's shuffled stream of words.

    The order is by hash; its first three hex digits deal a source to 4096 buckets.
    """
    key = stream_key(F.col("doc_id"), seed)
    rows = sized.join(sources.select(F.col("source").alias("s"), "sid"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("key", key).withColumn("bucket", F.substring("key", 1, 3))
    within = Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return placed.join(base, ["sid", "bucket"]).select("doc_id", "source", "size", "sid", (F.col("base") + F.col("inner")).alias("offset"))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """(slot, sid, first, words): which words of which source's endless stream each slot takes.

    A source's last slot is cut so that its words add up to its target, rounded
    down; what its slots leave open follows in slots after all others.
    """
    spark = sources.sparkSession
    facts = sources.agg(F.sum("source_size").alias("words"), F.count("*").alias("n")).first()
    slots, cells = -(-int(facts.words or 0) // block), max(4096, 4 * int(facts.n))
    whole = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = sources.where("target > 0").select(
        "sid", F.floor("target").cast("long").alias("due"), (F.sum("target").over(upto) / F.sum("target").over(whole)).alias("high"))
    shares = shares.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0)))
    shares = shares.withColumn("high", F.when(F.lead("sid").over(Window.orderBy("sid")).isNull(), F.lit(2.0)).otherwise(F.col("high")))
    # Points meet intervals by cell of a grid, an equality, and are then told apart within the cell.
    cell = F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells))))
    grid = shares.select("sid", "low", "high", cell.alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("u"))
    given = points.withColumn("cell", F.floor(F.col("u") * cells)).join(grid, "cell").where("u >= low and u < high").select("slot", "sid")
    given = given.withColumn("chunk", F.floor(F.col("slot") / _CHUNK))
    counts = given.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = given.withColumn("inner", rank).join(base, ["sid", "chunk"]).select("slot", "sid", (F.col("base") + F.col("inner")).alias("rank"))
    had = counts.groupBy("sid").agg(F.sum("n").alias("n"))
    open_ranks = shares.join(had, "sid", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") * block < F.col("due"))
    late = open_ranks.select("sid", F.explode(F.sequence("n", F.ceil(F.col("due") / block).cast("long") - 1)).alias("rank"))
    late = late.select((F.lit(slots) + F.col("rank")).alias("slot"), "sid", "rank")
    taken = ranked.unionByName(late).join(shares.select("sid", "due"), "sid").where(F.col("rank") * block < F.col("due"))
    return taken.select("slot", "sid", (F.col("rank") * block).alias("first"), F.least(F.lit(block), F.col("due") - F.col("rank") * block).alias("words"))


def pieces(placed: DataFrame, sources: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """(slot, sid, offset, begin, words): the words of each document that each slot takes, ``begin`` counted in the document."""
    length = sources.select("sid", F.col("source_size").alias("length"))
    turns = slots.join(length, "sid").withColumn("lap", F.explode(F.sequence(
        F.floor(F.col("first") / F.col("length")), F.floor((F.col("first") + F.col("words") - 1) / F.col("length")))))
    turns = turns.select(
        "slot", "sid", (F.greatest(F.col("first"), F.col("lap") * F.col("length")) - F.col("lap") * F.col("length")).alias("begins"),
        (F.least(F.col("first") + F.col("words"), (F.col("lap") + 1) * F.col("length")) - F.col("lap") * F.col("length")).alias("ends"))
    turns = turns.withColumn("block", F.explode(F.sequence(F.floor(F.col("begins") / block), F.floor((F.col("ends") - 1) / block))))
    spans = placed.where("size > 0").select("sid", "offset", "size", F.explode(F.sequence(
        F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block))).alias("block"))
    # Both sides are cut at block edges, so each word a slot takes is counted in one block.
    begin = F.greatest("begins", "offset", F.col("block") * block)
    end = F.least(F.col("ends"), F.col("offset") + F.col("size"), (F.col("block") + 1) * block)
    met = turns.join(spans, ["sid", "block"]).select("slot", "sid", "offset", (begin - F.col("offset")).alias("begin"), (end - begin).alias("words"))
    return met.where("words > 0")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block: int = 1024, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """The mix of all documents: (documents with ``taken`` words, pieces by slot).

    The first has a row per row of ``docs``: doc_id, source, size, source_size,
    target, taken. Words are runs of anything but ASCII white space; NULL and
    empty texts have none and are never taken. A NULL source is a source of its own,
    the last. Repeated rows are documents each. The order within a source hangs on
    doc_id and ``seed`` alone, so reruns agree. Other columns are ignored.
    """
    ready(docs.sparkSession)
    sized = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")), "sized")
    sources = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "sources")
    placed = stored(streams(sized, sources, seed), "streams")
    taken = stored(pieces(placed, sources, schedule(sources, block), block), "pieces")
    total = taken.groupBy("sid", "offset").agg(F.sum("words").alias("taken"))
    some = placed.where("size > 0").join(total, ["sid", "offset"], "left").unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    full = some.join(sources.select("sid", "source_size", "target"), "sid")
    return full.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), taken
