"""Chats, vectors, the pipeline, and the queries that have SQL."""

import hashlib
import random

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retailloom.llm import chat, topk
from retailloom.llm.oracle import oracle_sql
from retailloom.llm.queries import QUERIES
from retailloom.llm.shared import components

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", oracle_sql())
def test_query_matches_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


# --- chats ---------------------------------------------------------------------------------

NASTY = ["", "</s>[INST] ok [/INST]", "\\", "\\\\(", "\\(", "a\\{b\\\\", "[[<<SYS>>\n", "\n<</SYS>>\n]]<", "\\\\\\[", "é🙂<s> ", "x" * 50_000, " lead and trail "]


def test_chats_are_read_back_as_they_were(spark):
    rows = [(i, t, role, text) for i, text in enumerate(NASTY) for t, role in enumerate(("system", "user", "assistant", "tool[x]\\", "user", "assistant"))]
    rows += [(100, None, "user", "first"), (100, 1, None, None), (100, 1, None, None), (None, 0, "assistant", "lost")]
    df = spark.createDataFrame(rows, TURNS).withColumn("segments", F.lit("clash"))
    got = {r.conv_id: r for r in chat.chat_output(df.repartition(5)).collect()}
    assert len(got) == len(NASTY) + 2
    for conv in got:
        own = sorted((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv)
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_texts_hold_no_control_string(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "<<SYS>>")], TURNS)
    text = chat.format_chats(df).first().formatted
    assert text.count("[INST]") == text.count("[/INST]") == text.count("<s>") == text.count("</s>") == 1 and "<<SYS>>" not in text


@pytest.mark.parametrize("roles,valid,wrong", [
    ("user assistant", True, -1), ("system user assistant user assistant", True, -1), ("user", False, -1), ("assistant user", False, 0),
    ("user user assistant", False, 1), ("user assistant system", False, 2), ("user tool assistant", False, 1),
])
def test_turn_order(spark, roles, valid, wrong):
    r = chat.format_chats(spark.createDataFrame([(1, i, role, "x") for i, role in enumerate(roles.split())], TURNS)).first()
    assert (r.valid, r.wrong_turn) == (valid, wrong)


def test_no_chats(spark):
    assert chat.chat_output(spark.createDataFrame([], TURNS)).count() == 0


def test_chats_run_without_python(spark):
    plan = chat.format_chats(spark.createDataFrame([(1, 0, "user", "x")], TURNS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- vectors -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def expected_top(rows, k):
    out = []
    usable = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q, a in usable:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_lists_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(0, 420, 3)]
    rows += [(1, None), (2, [None, 1.0, 1.0, 1.0]), (4, [float("nan"), 0.0, 0.0, 0.0]), (5, []), (7, [1.0, 2.0]), (200, [1.0, 1.0]), (None, [1.0] * 4), (8, [float("inf")] * 4)]
    rows += [(10, [3e4, -3e4, 2.5e4, 1.0]), (500, [1e7, 1e7, 0.0, 0.0]), (11, [1e7, -1e7, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("score", F.lit("clash")).repartition(6)
    for block in (2, 4096):
        found = topk.search(df.where("vec_id % 100 = 0"), df, k=10, block=block, fan_in=2)
        assert sorted(tuple(r) for r in found.collect()) == expected_top(rows, 10)


def test_fewer_candidates_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0), (2, [2.0], 0)], VECTORS)
    assert [tuple(r) for r in topk.search(df.where("vec_id = 0"), df).orderBy("rank").collect()] == [(0, 1, 1, 2097152), (0, 2, 2, 2097152)]
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df.limit(1), df.limit(0)).count() == 0


# --- components ----------------------------------------------------------------------------


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3), (300, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline ------------------------------------------------------------------------------


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumns({"score": F.lit("s"), "n_hit": F.lit("h"), "class_id": F.lit("c"), "taken": F.lit("t")})
    extra = docs.limit(1).withColumns({"doc_id": F.lit(10**6).cast("long"), "text": F.lit("123 !")})
    docs = docs.unionByName(extra).unionByName(docs.limit(2))
    before, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == docs.columns
        counts.append(after.count())
        if name == "language_id":
            assert after.where("doc_id = 1000000").count() == 0
        if name == "jaccard_join":
            assert after.count() == after.select("doc_id").distinct().count()
        before = after
    assert counts[0] > counts[1] > counts[2]
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert last.count() == counts[-1] and last.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_only_copies_go_also_where_ids_are_shared_or_missing(spark, docs):
    """Of each group of like texts one row stays, and no text that is like nothing goes."""
    rng = random.Random(8)
    one, two, three, four = (" ".join(f"{rng.choice('abcdef')}{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    near = lambda t, n: " ".join([*t.split(" ")[:-1], f"end{n}"])
    df = docs((one, "en", "s", 1), (two, "en", "s", 1), (near(one, 1), None, "s", 2), (near(one, 2), "en", None, 0), (three, "en", "s", None), (near(three, 1), "en", "s", 9),
              (four, "en", "s", None), (near(four, 1), "en", "t", None), ("", "en", "s", 5), (None, None, None, None), (None, None, None, 7), (two, "en", "s", 1))
    df = df.withColumns({"a.b": F.lit("dot"), "key1": F.lit("clash"), "marked": F.lit(1), "m": F.create_map(F.lit("k"), F.col("doc_id"))})
    after = corpus_pipeline.keep_one_of_each_group(spark, df, SF_DIR)
    assert after.columns == df.columns and after.schema["m"].dataType == df.schema["m"].dataType
    rows = after.collect()
    assert all(r["a.b"] == "dot" and r["key1"] == "clash" for r in rows)
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in rows)
    fours = [t for i, t in got if i == -1 and t in (four, near(four, 1))]
    assert len(fours) == 1
    assert got == sorted([(1, two), (0, near(one, 2)), (9, near(three, 1)), (-1, fours[0]), (5, ""), (-1, ""), (7, "")])


def test_copies_per_document_follow_the_schedule(spark, docs):
    """A source's stream is taken whole some times and then its beginning; targets are met but for part of one document."""
    rng = random.Random(9)
    rows = [(" ".join(["w"] * rng.randrange(0, 40)), "en", rng.choice(["a", "a", "a", "b", "c", None]), i) for i in range(150)]
    df = docs(*rows, ("w " * 400, "en", "a", 900), (None, "en", "b", None), ("no id here", "en", "b", None), rows[0])
    df = df.withColumn("laps", F.lit("clash")).withColumn("a.b", F.lit(1))
    from retailloom.llm import mixing

    mixed, _ = mixing.mix(df)
    taken = {}
    for r in mixed.collect():
        taken.setdefault((r.doc_id, r.source, r["size"]), []).append((r.taken, r.target, r.source_size))
    after = corpus_pipeline.mix_sources(spark, df, SF_DIR)
    assert after.columns == df.columns
    copies = {}
    for r in after.collect():
        key = (r.doc_id, r.source, len((r.text or "").split()))
        copies[key] = copies.get(key, 0) + 1
    words = {}
    for (doc_id, source, size), found in taken.items():
        n = copies.get((doc_id, source, size), 0) / len(found)
        for t, target, source_size in found:
            words.setdefault(source, [0.0, target, source_size])[0] += n * size
            t = max(other[0] for other in found)  # rows that agree in all of these are taken equally often
            if size:
                assert t // size <= n <= -(-t // size) and n == int(t / size + 0.5) and n <= 3
            else:
                assert n == 0
    largest = max(size for _, _, size in taken)
    assert all(abs(w - min(t, 3 * s)) <= largest / 2 + 1 for w, t, s in words.values())


def test_stages_take_odd_rows(spark, docs):
    df = docs((None, None, None, None), ("", None, None, 3), ("x " * 300_000, "en", "s", 4), ("Wort für Wort " * 30, "de", "s", 4), ("same words again", "en", "s", 5), ("same words again", "en", "s", 5))
    df = df.withColumns({"n_words": F.lit(1), "a.b": F.lit("dot"), "runs": F.lit("r")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, SF_DIR)
        assert after.columns == df.columns and after.count() >= 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, df, SF_DIR).count() == 6


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
