"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailloom.llm import chat, collocations, decontaminate, jaccard, language, lexical, licenses, mixing, neighbours, quality, secrets, tokens, topk
from retailloom.llm.oracle import oracle_sql  # noqa: F401
from retailloom.llm.shared import held_out, ready

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand in directories source / thousands / hundreds of their ids."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.fit(docs)))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation that says the template's own control strings.
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    return chat.chat_output(turns.unionByName(extra))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors.where("vec_id % 100 = 0"), vectors)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.where("vec_id % 100 = 0"), vectors)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_license_scan, op2_token_output, op3_language_id, op4_decontaminate, op5_secret_scan,
    op6_jaccard_join, op7_quality, op8_chat_format, op9_source_mix, op10_topk,
    op11_collocations, op12_lexical_search, op13_neighbours)}
