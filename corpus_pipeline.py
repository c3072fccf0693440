"""From raw documents to token files, stage by stage; each stage is written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.llm import decontaminate, jaccard, language, mixing, tokens
from retailloom.llm.queries import table, tokenizer_path
from retailloom.llm.shared import ready, stored


def _set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """Renames all columns but those used, so that none clashes with what an operator adds, whatever its name holds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in used else f"kept:{i}") for i, c in enumerate(docs.columns)])


def _restored(found: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    return found.select(*[F.col(f"`{c if c in used else f'kept:{i}'}`").alias(c) for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without a letter, or far from every language, go."""
    found = language.identify(_set_aside(docs, "text"), language.fit(docs))
    return _restored(found.where("not rejected"), docs, "text")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group one row stays, that of the smallest id, rows without an id after all others.

    Rows are told apart by id and set of shingles, so a text stays whose id another
    text shares. Rows without words are like nothing and all stay. Only rows whose set may be among those that go are
    shuffled, as told by a bitmap of at most 2 MB.
    """
    rows, sets = jaccard.grouped(docs, nameless=True)
    key = ["doc_id", "key1", "key2"]
    placed = rows.where("n_tokens > 0").groupBy(*key).agg(F.count("*").alias("n")).join(sets.select("key1", "key2", "class"), ["key1", "key2"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), *key)).alias("first")
    placed = placed.join(placed.groupBy("class").agg(first), "class")
    stays = F.struct(*key).eqNullSafe(F.struct(*[F.col(f"first.{c}") for c in key]))
    touched = placed.where(~stays | (F.col("n") > 1)).select(*[F.col(c).alias(f"dup:{c}") for c in key], stays.alias("dup:stays"))
    touched = stored(touched, "touched")
    bits = jaccard.key_bits(touched.select(F.col("`dup:key1`").alias("key1")))
    aside = _set_aside(docs, "doc_id", "text")
    keyed = jaccard.with_keys(aside, bits)
    met = keyed.where("marked").join(touched, _same("doc_id", "key1", "key2"), "left").where("`dup:stays` is null or `dup:stays`")
    single = met.where("`dup:stays` is null").unionByName(met.where("`dup:stays`").dropDuplicates(key))
    kept = keyed.where("not marked").select(*_columns(aside)).unionByName(single.select(*_columns(aside)))
    return _restored(kept, docs, "doc_id", "text")


def _same(*names: str) -> Column:
    """Equal ids and keys, a missing id being equal to a missing id."""
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"`dup:{c}`"))
    return same


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    found = decontaminate.judged(decontaminate.overlaps(_set_aside(docs, "text"), table(spark, sf_dir, "benchmark")))
    return _restored(found.where("not contaminated"), docs, "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    The mix takes each source's stream whole so many times and then a beginning
    of it, so a document has as many copies as there are laps and, up to one document, one more. That document, of
    which a part is taken, is written if the part is half of it or more. Documents without words go. Rows that
    agree in doc_id, source and number of words are taken equally often.
    Texts are not shuffled: what is known of a source is one row.
    """
    mixed, _ = mixing.mix(docs)
    lap = F.col("size") * F.col("laps")
    place = F.struct(mixing.stream_key(F.col("doc_id")).alias("key"), "doc_id", "size")
    counted = mixed.where("size > 0").withColumn("laps", F.floor(F.floor("target") / F.col("source_size")))
    last = F.max(F.when(2 * (F.col("taken") - lap) >= F.col("size"), place))
    per_source = stored(counted.groupBy("source").agg(F.max("laps").alias("mix:laps"), last.alias("mix:last")).withColumnRenamed("source", "mix:source"), "mix-sources")
    aside = _set_aside(docs, "doc_id", "text", "source")
    sized = aside.withColumn("size", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)).cast("long")).where("size > 0")
    met = sized.join(per_source, F.col("source").eqNullSafe(F.col("`mix:source`")))
    here = F.struct(mixing.stream_key(F.col("doc_id").cast("long")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "size")
    more = F.when(F.col("`mix:last`").isNotNull() & (here <= F.col("`mix:last`")), 1).otherwise(0)
    times = (F.col("`mix:laps`") + more).cast("int")
    copied = met.withColumn("mix:copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times))))
    return _restored(copied, docs, "doc_id", "text", "source")


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all that is left, and per document what they hold."""
    return tokens.token_output(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", keep_one_of_each_group),
    ("decontaminate", decontaminate_benchmark),
    ("source_mix", mix_sources),
    ("token_output", write_token_ids),
]

#: Language identification and the join over hashed paths have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
