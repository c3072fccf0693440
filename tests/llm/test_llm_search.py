"""Collocations, ranked lexical search and approximate neighbours against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from urllib.parse import urlparse

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest

from retailloom.llm import collocations, lexical, neighbours

U64 = np.uint64

# --- counting quotient filters -------------------------------------------------------------


@pytest.mark.parametrize("bits", [(1, 1), (1, 64), (5, 10), (17, 34), (32, 64), (32, 32)])
def test_permutation_is_inverted(bits):
    rng = np.random.default_rng(1)
    quotient = rng.integers(0, 1 << bits[0], 5000, dtype=U64)
    remainder = rng.integers(0, 2**64 - 1, 5000, dtype=U64) & collocations._low(bits[1])
    scrambled = collocations.permuted(quotient, remainder, bits)
    assert scrambled[0].max() < 1 << bits[0] and int(scrambled[1].max()) < 1 << bits[1]
    back = collocations.restored(*scrambled, bits)
    assert (back[0] == quotient).all() and (back[1] == remainder).all()


def test_permutation_of_all_keys_is_one_to_one():
    quotient, remainder = (x.ravel().astype(U64) for x in np.meshgrid(np.arange(32), np.arange(256)))
    scrambled = collocations.permuted(quotient, remainder, (5, 8))
    assert len(set(zip(*(x.tolist() for x in scrambled), strict=True))) == 32 * 256


@pytest.mark.parametrize("bits", [1, 8, 33, 64])
def test_filters_are_read_as_written(bits):
    rng = np.random.default_rng(2)
    quotient = np.concatenate([rng.integers(0, 40, 900), [10**6, 2**32 - 1]]).astype(U64)
    remainder = rng.integers(0, 2**64 - 1, 902, dtype=U64) & collocations._low(bits)
    count = np.concatenate([rng.integers(1, 400, 900), [254, 10**14]])
    filled = collocations.tallied(quotient, remainder, count)
    back = collocations.read(*collocations.written(*filled, bits), bits)
    assert all((a == b).all() for a, b in zip(filled, back, strict=True))
    expected = Counter()
    for q, r, c in zip(quotient.tolist(), remainder.tolist(), count.tolist(), strict=True):
        expected[q, r] += c
    assert dict(zip(zip(filled[0].tolist(), filled[1].tolist(), strict=True), filled[2].tolist(), strict=True)) == expected
    empty = collocations.tallied(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64))
    assert len(collocations.read(*collocations.written(*empty, bits), bits)[0]) == 0


# --- collocations --------------------------------------------------------------------------


def expected_phrases(rows, least, share=50, best=2000):
    grams, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                grams[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in grams.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in held.items():
            longer = [b for q, b in held.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * b >= share * a for b in longer):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=repr)


def prose(rng, words):
    marks = [" ", " ", " ", " ", ", ", ". ", "\n", "\t", " \t "]
    return "".join(rng.choice(["Red", "red", "fox", "Ünd", "ünd", "a\x00b", "it's", "(x)", "日本", "z" * 300]) + rng.choice(marks) for _ in range(words))


def test_collocations_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(prose(rng, rng.randrange(0, 60)), rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [("same words here. " * 3, "en")] * 7 + [(None, "en"), (None, None), ("", "fr"), ("...!", "fr"), (prose(rng, 4000), "de"), ("x" * 200_000, "en")]
    df = spark.createDataFrame([(t, lang, "clash") for t, lang in rows], "text string, lang string, word string").repartition(5)
    for least, best in ((4, 2000), (10, 7)):
        got = sorted((tuple(r) for r in collocations.collocations(df, least=least, best=best).collect()), key=repr)
        assert got == expected_phrases(rows, least, best=best) and got


def test_shards_and_ranges_do_not_change_counts(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(prose(rng, 80), rng.choice(["en", "de"])) for _ in range(80)], "text string, lang string").repartition(3)

    def counted(**how):
        grams, words, _ = collocations.phrases(df, 3, **how)
        names = {(r.lang, r.id): r.word for r in words.collect()}
        assert len(names) == words.count()
        return {(r.lang, *(names.get((r.lang, i)) for i in (r.first, r.second, r.third))): r.a for r in grams.collect()}

    assert counted(shard_bytes=500, merge_slots=50) == counted() != {}


def test_scores_of_large_counts_are_exact(spark):
    cases = [(10**15, 10**15, 10**15), (999_999_999_999_999, 10**15, 7 * 10**14), (3 * 10**9, 3 * 10**9, 3 * 10**9 + 1), (10, 3, 7)]
    df = spark.createDataFrame(cases, "a long, l long, r long").withColumn("score", collocations._score("a", "l", "r"))
    assert [r.score for r in df.collect()] == [10**6 * a * a // (left * right) for a, left, right in cases]


def test_a_reader_holds_one_shard_at_a_time(spark, monkeypatch):
    df = spark.createDataFrame([(f"one two three w{i} " * 20, f"l{i % 10}") for i in range(30)], "text string, lang string").coalesce(1)
    seen, store = {}, collocations.stored
    monkeypatch.setattr(collocations, "stored", lambda df, label, *a, **how: seen.setdefault(label, store(df, label, *a, **how)))
    collocations.phrases(df, 3)
    files = [pq.ParquetFile(urlparse(f).path).metadata for f in seen["shards"].inputFiles()]
    assert max(f.num_rows for f in files) == 10
    assert all(f.num_row_groups == f.num_rows for f in files)


def test_no_documents_no_collocations(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("one", "en")], "text string, lang string")).count() == 0


# --- ranked lexical search -----------------------------------------------------------------


def expected_ranks(docs, items, k):
    terms = [brute.words(t) for _, t in docs]
    held = [Counter(t) for t in terms]
    total, tokens = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(t for c in held for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id].update(brute.words(text))
    out = []
    for item_id, wanted in asked.items():
        scored = []
        for (doc_id, _), counts, own in zip(docs, held, terms, strict=True):
            m = 10 + 90 * len(own) * total // tokens if tokens else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m)) for t in wanted if counts[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, n, None if none else doc_id, -s) for n, (s, none, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def lexical_case():
    rng = random.Random(6)
    common, rare = [f"w{i}" for i in range(12)], [f"r{i}é" for i in range(400)]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.7 else rng.choice(rare).upper() for _ in range(n))

    docs = [(i, text(rng.randrange(0, 40))) for i in range(300)]
    docs += [(5, "same same"), (5, "same same"), (7, "same same"), (None, "same same"), (900, None), (901, ""), (902, "!!"), (903, text(30_000)), (904, "w1")]
    items = [(i, text(rng.randrange(1, 25))) for i in range(40)]
    items += [(3, "extra terms r3é"), (None, "w1 same"), (77, None), (78, ""), (79, "unknownword"), (80, "SAME w1 same"), (81, text(3000))]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"block_items": 4, "docs_per_segment": 20}, {"k": 3, "docs_per_segment": 7}])
def test_ranks_equal_brute_force(spark, how):
    docs, items = lexical_case()
    given = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(4)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string").repartition(3)
    got = sorted((tuple(r) for r in lexical.search(given, asked, **how).collect()), key=repr)
    assert got == expected_ranks(docs, items, how.get("k", 10))


def test_nothing_to_rank(spark):
    docs, items = "doc_id long, text string", "item_id string, text string"
    some = spark.createDataFrame([("a", "one two")], items)
    for given in ([], [(1, None), (2, "...")], [(1, "three")]):
        assert lexical.search(spark.createDataFrame(given, docs), some).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "one")], docs), some.limit(0)).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "one"), (2, "x")], docs), some).first().item_id == "a"


# --- approximate neighbours ----------------------------------------------------------------


def vectors(spark, rows, parts=6):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(parts)


def exact(rows, k=10):
    """{query: [(distance, vec_id)]} over all usable rows."""
    usable = {(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    first = {}
    for i, v in sorted(usable):
        first.setdefault(i, v)
    return {i: sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w, strict=True))), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            for i, v in first.items() if i % 100 == 0}


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(0, 500, 3)]
    rows += [(1, None), (2, [None, 1.0, 1.0, 1.0]), (4, [float("nan"), 0.0, 0.0, 1.0]), (5, []), (7, [1.0, 2.0]), (200, [1.0, 1.0]), (None, [1.0] * 4), (8, [float("inf")] * 4), (10, [0.0] * 4)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(1000, 1030)] + [(300, rows[0][1])] + [rows[3]] * 3
    df = vectors(spark, rows)
    got = found(neighbours.nearest(df.where("vec_id % 100 = 0"), df))
    want = {q: near for q, near in exact(rows).items() if near}
    assert set(got) == set(want)
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in near])


def test_recall_on_a_table_of_many_blocks(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 24))
    points = centres[rng.integers(0, 30, 4000)] + 0.4 * rng.normal(size=(4000, 24))
    points[2500:3500] = points[2500] + 1e-3 * rng.normal(size=(1000, 24))  # one large group of near copies
    points[3500:3800] = points[100]  # and one of exact copies
    rows = list(enumerate(points.astype(np.float32).tolist()))
    df = vectors(spark, rows)
    index = neighbours.build(df, k=16, reverse=16, block_rows=256)
    assert index.graph.count() == index.nodes.count() == 4000 - 300
    got, want = found(neighbours.search(df.where("vec_id % 100 = 0"), index, beam=96, starts=128)), exact(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert all(s == pytest.approx(math.dist(rows[q][1], rows[i][1]), abs=1e-12) for q, near in got.items() for s, i in near)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) / (10 * len(want))
    assert hit >= 0.9, {q: len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want}
    # Exact copies are settled by their ids.
    assert [i for _, i in got[100]] == list(range(3500, 3510)) and [i for _, i in got[3600]][:2] == [100, 3500]


def test_lists_of_a_round_are_the_nearest_of_what_was_met():
    owner, other = np.array([1, 1, 1, 2, 1, 2]), np.array([5, 6, 5, 9, 7, 9])
    dist = np.array([3.0, 1.0, 3.0, 2.0, 2.0, 2.0], np.float32)
    stale = np.array([False, False, True, True, False, False])
    best = neighbours._nearest(owner, other, dist, 2, stale)
    assert list(zip(owner[best], other[best], stale[best], strict=True)) == [(1, 6, False), (1, 7, False), (2, 9, True)]


def test_no_vectors(spark):
    df = vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0])])
    assert neighbours.nearest(df.where("vec_id = 0"), df.limit(0)).count() == 0
    assert neighbours.nearest(df.limit(0), df).count() == 0
    assert found(neighbours.nearest(df.where("vec_id = 0"), df)) == {0: [(0.5, 1)]}


def test_a_step_shuffles_walkers_with_the_graph_and_what_they_tell_with_their_state(spark, monkeypatch):
    exchanges = {}

    def seen(df, label, *rest, **options):
        exchanges.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return plain(df, label, *rest, **options)

    plain = neighbours.stored
    monkeypatch.setattr(neighbours, "stored", seen)
    rng = np.random.default_rng(3)
    df = vectors(spark, [(i, rng.normal(size=4).tolist()) for i in range(300)])
    assert neighbours.nearest(df.where("vec_id % 100 = 0"), df).count() == 30
    assert max(exchanges["walks"][2:]) <= 2 and max(exchanges["graph"]) <= 6
