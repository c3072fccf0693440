"""Operators over documents against plain Python, with NULLs, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from retailloom.llm import decontaminate, jaccard, language, licenses, mixing, quality, secrets, tokens
from retailloom.llm.queries import tokenizer_path
from retailloom.llm.shared import held_out


def prose(rng, n, letters="abcdefg"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(5)


# --- tokens --------------------------------------------------------------------------------


def expected_tokens(rows):
    from tokenizers import Tokenizer

    encode, start, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*encode.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_hold_the_ids_of_whole_texts(spark, docs, rng, path):
    texts = ["", None, "A\tb  c d\n\ne", "<|endoftext|> x<|startoftext|>y", "é ́a don't I'LL 42%", "x" * 5000, prose(rng, 4000)]
    df = docs(*texts, *[prose(rng, 20) for _ in range(30)], ("same", None, None, 3), ("same", None, None, 3), ("no id", None, None, None))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = [tuple(r) for r in tokens.token_output(df, tokenizer_path()).orderBy("start").collect()]
    assert got == expected_tokens(rows)


def test_token_files_are_laid_out_for_selective_reads(spark, docs, rng, path):
    import glob

    import pyarrow.parquet as pq

    tokens.write_tokens(docs(*[prose(rng, 50) for _ in range(1200)]), path("t"), tokenizer_path(), partitions=1)
    (file,) = glob.glob(path("t") + "/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    column = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert column["doc_id"].has_column_index and column["doc_id"].has_offset_index
    assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
    assert any("DICTIONARY" in e for e in column["ids.list.element"].encodings)
    plan = tokens.read_tokens(spark, path("t")).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan


def test_token_output_of_no_documents_is_empty(spark, docs):
    assert tokens.token_output(docs(), tokenizer_path()).count() == 0


# --- languages -----------------------------------------------------------------------------


@pytest.fixture
def languages(docs, rng):
    alphabets = {"aa": "abcde", "bb": "vwxyz", "cc": "éèüßö"}
    return docs(*[(prose(rng, rng.randint(5, 40), alphabets[lang]), lang, "s") for lang in alphabets for _ in range(60)])


def test_held_out_languages_are_found(languages):
    found = language.identify(languages, language.fit(languages)).collect()
    assert len(found) == 180 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 and not r.rejected for r in found)


def test_texts_without_letters_or_near_no_language_are_rejected(spark, languages, docs):
    model = language.fit(languages)
    odd = docs(None, "", "12 !?", "日本語の文章です", "A", "x" * 100_000).withColumn("score", F.lit("kept elsewhere"))
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and all(got[i].rejected for i in range(4))
    assert got[3].lang_pred in ("aa", "bb", "cc") and got[4].lang_pred == "aa" or got[4].lang_pred in ("bb", "cc")
    assert language.identify(docs("abc"), None).first().lang_pred == "und"
    assert language.fit(docs("abc", None)) is None
    assert language.identify(docs(), model).count() == 0


FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "th": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
          "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin.",
}


def test_foreign_texts_and_noise_are_rejected_and_known_languages_kept(spark, docs, rng):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(given)
    kept = language.identify(given.where(held_out()), model).agg(F.count("*").alias("n"), F.sum(F.col("rejected").cast("int")).alias("lost")).first()
    assert kept.n > 150 and kept.lost <= 0.01 * kept.n
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    noise = ["".join(rng.choice(letters) for _ in range(3000)), "".join(rng.choice(letters[26:52] + "    ") for _ in range(3000))]
    odd = [*FOREIGN.values(), *[(t + " ") * 20 for t in FOREIGN.values()], *noise]
    assert [t[:20] for t, r in zip(odd, language.identify(docs(*odd), model).orderBy("doc_id").collect(), strict=True) if not r.rejected] == []


def test_more_languages_than_allowed_are_an_error(docs):
    many = docs(*[(f"word{i}", f"l{i:03}", "s") for i in range(800)])
    with pytest.raises(ValueError, match="more than 500 languages"):
        language.fit(many)


def test_predictions_do_not_look_at_other_columns(languages):
    model = language.fit(languages)
    swapped = languages.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "doc_id": F.lit(0).cast("long")})
    assert sorted(r.lang_pred for r in language.identify(swapped, model).collect()) == sorted(
        r.lang_pred for r in language.identify(languages, model).collect())


# --- decontamination -----------------------------------------------------------------------


def judged(docs, benchmark, **options):
    return {(r.doc_id, r.text): r for r in decontaminate.judged(decontaminate.overlaps(docs, benchmark, **options)).collect()}


@pytest.mark.parametrize("block", [3, 200_000])
def test_contamination_equals_brute_force(spark, docs, rng, block):
    items = [(i, prose(rng, n, "abc")) for i, n in enumerate([1, 2, 5, 12, 13, 14, 40])] + [(7, None), (8, "... !"), (None, "lost words"), (3, "twice twice")]
    pieces = [t for _, t in items if t] + [prose(rng, 3, "abc")]
    texts = [None, "", "..."] + [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))).upper() for _ in range(40)] + [prose(rng, 500, "abc")]
    texts += texts[5:8]
    got = decontaminate.judged(decontaminate.overlaps(
        docs(*texts).withColumn("n_words", F.lit("clash")), spark.createDataFrame(items, "item_id long, text string"), block_rows=block)).collect()
    assert len(got) == len(texts)
    for r in got:
        n, hit, found = brute.overlap(r.text, [i for i in items if i[0] is not None])
        names = ",".join(sorted(map(str, found)))
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
        assert r.items_sha256 == hashlib.sha256(names.encode()).hexdigest() and r.contaminated == (hit > 0 and 20 * hit >= n)


def test_empty_benchmark_and_empty_documents(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in judged(docs("a b c"), nothing).values()] == [False]
    assert judged(docs(), spark.createDataFrame([(1, "a")], "item_id long, text string")) == {}


# --- secrets -------------------------------------------------------------------------------


def test_secrets_equal_the_patterns_and_the_model_adds_random_words(spark, docs, rng):
    def random_key(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    plain = [prose(rng, 40) + f" password = '{random_key(18)}' and token:{random_key(40)} AKIA{random_key(16).upper()}" for _ in range(30)]
    hidden = random_key(28)
    texts = [*plain, None, "", "é" * 10 + f" API-KEY apikey={random_key(7)} ", f"the word {hidden} stands alone", "Paſſword=12345678", prose(rng, 20_000)]
    df = docs(*texts, *texts[:2])
    got = secrets.digest(secrets.scan(df, secrets.fit(df))).collect()
    assert len(got) == len(texts) + 2
    text = {r.doc_id: r.text or "" for r in df.collect()}
    for r in got:
        own = brute.base_spans(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in own).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in own) for k in ("assign", "access", "hex"))
        assert {f"{k}:{a}:{b}" for k, a, b in own} <= set(r.spans.split(",")) | {""}
        added = [text[r.doc_id][int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.spans.split(",") if s.startswith("markov")]
        assert added == ([hidden] if hidden in text[r.doc_id] else [])


def test_secrets_without_labels_or_rows(spark, docs):
    assert secrets.fit(docs("nothing here")) is None
    assert secrets.digest(secrets.scan(docs("nothing here"), None)).first().spans == ""
    assert secrets.scan(docs(), secrets.fit(docs())).count() == 0


# --- near duplicates -----------------------------------------------------------------------


def changed(rng, text, n):
    own = text.split(" ")
    for _ in range(n):
        own[rng.randrange(len(own))] = "new" + str(rng.randrange(10**6))
    return " ".join(own)


def test_links_and_classes_equal_brute_force(spark, docs, rng):
    base = [prose(rng, rng.randint(30, 120)) for _ in range(12)]
    texts = base + [changed(rng, t, rng.randint(0, 3)) for t in base for _ in range(4)]
    texts += [None, "", "...", "two words", "Two, words!", "a b c d", "a b c d e", "a b c d e f", prose(rng, 8000)] + base[:2]
    rng.shuffle(texts)
    df = docs(*texts, ("no id", None, None, None)).withColumn("class_id", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = brute.near_duplicates(rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id, r.n_links) for r in jaccard.near_duplicates(df).collect())
    assert got == sorted((rows[i][0] if rows[i][0] is not None else -1, c, n) for i, (c, n) in expected.items())


@pytest.mark.parametrize("bucket", [8, 512])
def test_large_groups_are_compared_in_blocks(spark, docs, rng, bucket):
    base = prose(rng, 150)
    texts = [changed(rng, base, 1) for _ in range(40)] + [base] * 20 + [prose(rng, 30) for _ in range(20)]
    df = docs(*texts)
    expected = brute.near_duplicates([(r.doc_id, r.text) for r in df.collect()])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(df, bucket=bucket).collect()}
    assert got == expected


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark, docs, rng):
    one, two, three = (prose(rng, 60) for _ in range(3))
    df = docs((one, None, None, 1), (two, None, None, 1), (changed(rng, one, 1), None, None, 2), (changed(rng, two, 1), None, None, 0), (three, None, None, 2), (one, None, None, None))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = brute.near_duplicates(rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id, r.n_links) for r in jaccard.near_duplicates(df).collect())
    assert got == sorted((rows[i][0] if rows[i][0] is not None else -1, c, n) for i, (c, n) in expected.items())
    assert {(1, 1, 1), (1, 0, 1), (2, 1, 1), (0, 0, 1)} <= set(got)


def copies(rng, n, words=120):
    """Different near copies of one text, any two of them alike, and a few that are like some of them only."""
    base = prose(rng, words)
    near = [" ".join([*base.split(" ")[:-2], f"x{i}", f"y{i}"]) for i in range(n)]
    halfway = [changed(rng, near[i], 3) for i in range(0, n, max(1, n // 12))]
    return near + halfway


def test_near_copies_beyond_a_bucket_keep_every_link(spark, docs, rng):
    df = docs(*copies(rng, 120), *[prose(rng, 40) for _ in range(15)])
    expected = brute.near_duplicates([(r.doc_id, r.text) for r in df.collect()])
    for bucket, rounds, block_rows in ((16, 3, 1024), (16, 1, 32), (16, 0, 50)):
        got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.near_duplicates(df, bucket=bucket, rounds=rounds, block_rows=block_rows).collect()}
        assert got == expected


def test_rows_of_a_near_copy_group_grow_with_its_members(spark, docs, rng, monkeypatch):
    """Candidate rows and exact rows at n, 2n and 4n different near copies."""
    written, real = {}, jaccard.stored
    seen = []

    def stored(df, label, *a, **b):
        out = real(df, label, *a, **b)
        if label in ("alike", "links", "members", "paired"):
            seen.append((label, out.count()))
        return out

    monkeypatch.setattr(jaccard, "stored", stored)
    for n in (150, 300, 600):
        seen.clear()
        jaccard.near_duplicates(docs(*copies(rng, n, 60)), bucket=64).count()
        written[n] = {label: sum(c for k, c in seen if k == label) for label in ("alike", "links", "paired")}
    for label in ("alike", "links"):
        assert written[600][label] <= 4.4 * written[150][label] and written[300][label] <= 2.2 * written[150][label], (label, written)
    # Members stand in as many buckets as they have leaves, however many they are.
    assert all(written[n]["paired"] <= 40 * n for n in written), written


def test_no_documents_have_no_duplicates(docs):
    assert jaccard.near_duplicates(docs()).count() == 0


def test_runs_reach_the_recall_on_paths(rng):
    """Pairs at the bound share a bucket in at least the promised share of cases."""
    import pyarrow as pa

    from retailloom.llm.text import slices

    met = 0
    with np.errstate(over="ignore"):
        for _ in range(150):
            own = [f"w{rng.randrange(10**9)}" for _ in range(204)]
            pair = [" ".join(own), " ".join(own[:164])]  # 160 of 200 runs in common
            (_, _, data, at), = slices(pa.array(pair))
            keys, sizes = jaccard.token_sets(data, at, 5)
            assert sizes.tolist() == [200, 160]
            row, leaf = jaccard.paths(keys, sizes, 0.8, 1.25, 2, jaccard.runs_needed(0.99, 1.25, 2))
            met += bool(set(leaf[row == 0].tolist()) & set(leaf[row == 1].tolist()))
    assert met >= 145


# --- quality -------------------------------------------------------------------------------


def test_quality_is_learnt_and_whole_texts_count(spark, docs, rng):
    good = [prose(rng, rng.randint(10, 60)) for _ in range(120)]
    bad = [prose(rng, rng.randint(10, 60)).replace(" ", "$$$ ") for _ in range(60)]
    df = docs(*good, *bad)
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(180)] + [(None, 1, 0), (0, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r for r in quality.score(df, model).collect()}
    right = [got[i].predicted == int(i < 120) for i in range(180) if got[i].held_out]
    assert sum(right) >= 0.9 * len(right) and all(0 <= r.score <= 1 for r in got.values())
    odd = quality.score(docs(None, "", "x", "y$$$ " * 100_000, "same", "same").withColumn("score", F.lit("clash")), model).orderBy("doc_id").collect()
    assert odd[0].score == odd[1].score and odd[4].score == odd[5].score and odd[3].predicted == 0


def test_quality_without_labels_or_rows(spark, docs):
    model = quality.fit(docs("a b"), spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(docs("a b"), model).first().score == 0.5
    assert quality.score(docs(), model).count() == 0


# --- licences ------------------------------------------------------------------------------


def test_licences_are_found_and_inherited(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/c/x.py", "print(1)\n"), (3, "a/b/LICENSE.txt", "Released under the MIT License."),
        (4, "a/y.py", "# Licensed under CC BY-NC 4.0.\ncode and more code and yet more of it"), (5, "z.py", None), (6, None, "Released under the MIT License."), (7, "q/z.py", ""),
        (8, "a/b/c/x.py", "print(1)\n"), (9, "a/bc/x.py", "license to the of under"), (10, "deep/" * 30 + "f", "x"),
    ], "doc_id long, path string, text string").withColumn("license", F.lit("clash"))
    got = {r.doc_id: r for r in licenses.scan(files).collect()}
    assert len(got) == 10
    assert {i: got[i].license for i in got} == {
        1: "Apache-2.0", 2: "MIT", 3: "MIT", 4: "CC-BY-NC-4.0", 5: None, 6: "MIT", 7: None, 8: "MIT", 9: "Apache-2.0", 10: None}
    assert got[2].inherited_from == "a/b/LICENSE.txt" and got[9].inherited_from == "a/LICENSE" and got[9].own_license is None
    assert got[1].is_license_file and not got[4].is_license_file


def test_common_words_beside_a_licence_weigh_little(spark, rng):
    """Scores equal TF-IDF with the counted frequencies of all words, whatever the number of files."""
    common = "alpha beta gamma delta"
    texts = [f"{common} {prose(rng, 5)}" for _ in range(300)] + [f"Released under the MIT License {common}", None, f"x\nReleased {common} under the MIT, License alpha"]
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in licenses.scan(files).collect()}
    held = [set(re.findall("[a-z0-9]+", (t or "").lower())) for t in texts]

    def idf(word):
        return 1 + math.log((1 + len(texts)) / (1 + sum(word in h for h in held)))

    def vector(text):
        raw = {w: n * idf(w) for w, n in Counter(re.findall("[a-z0-9]+", text.lower())).items()}
        return {w: x / math.sqrt(sum(y * y for y in raw.values())) for w, x in raw.items()}

    for i in (300, 302):
        best = max(sum(vector(p).get(w, 0) * x for w, x in vector("Released under the MIT License.").items()) for p in [texts[i], *texts[i].split("\n")])
        assert best > 0.9 and got[i].own_license == "MIT" and abs(got[i].own_score - best) < 2e-6
    assert len(got) == 303 and got[0].own_license is None and got[301].own_license is None


def test_no_files_have_no_licences(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


# --- mixing --------------------------------------------------------------------------------


def test_mix_meets_its_targets(spark, docs, rng):
    sizes = {"a": 400, "b": 30, "c": 5, "d": 60, None: 20, "e": 3}
    rows = [(prose(rng, rng.randint(1, 80)), None, s) for s, n in sizes.items() for _ in range(n)] + [(None, None, "a"), ("", None, "b"), (" \n", None, "f")]
    df = docs(*rows, *rows[:3]).withColumn("taken", F.lit("clash"))
    mixed, taken = mixing.mix(df, block=64)
    got = mixed.collect()
    assert len(got) == len(rows) + 3 and sorted(mixed.collect()) == sorted(got)
    total, used, target = {}, {}, {}
    for r in got:
        total[r.source] = total.get(r.source, 0) + r["size"]
        used[r.source] = used.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    assert {r.source: r.source_size for r in got} == total
    expected = brute.targets(total)
    for source in total:
        assert abs(target[source] - expected[source]) < 1e-6 and expected[source] - 1 <= used[source] <= expected[source]
    # Slots of the schedule are equal blocks, interleaved from the start.
    slots = taken.groupBy("slot", "sid").agg(F.sum("words").alias("words")).collect()
    assert max(s.words for s in slots) == 64 and len({s.slot for s in slots}) == len(slots)
    early = {s.sid for s in slots if s.slot < 40}
    assert {1, 2, 4, 6} & early and len(early) >= 3


def test_mixing_nothing(docs):
    assert mixing.mix(docs())[0].count() == 0
    got = mixing.mix(docs(None, ""))[0].collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_golden_points_are_spread(spark):
    points = [r.u for r in spark.range(2000).select(mixing.point(F.col("id")).alias("u")).collect()]
    counts = np.bincount((np.array(points) * 20).astype(int), minlength=20)
    assert counts.min() >= 98 and counts.max() <= 102
    far = spark.range(1 << 40, (1 << 40) + 3).select(mixing.point(F.col("id")).alias("u")).collect()
    steps = [(b.u - a.u) % 1 for a, b in zip(far, far[1:], strict=False)]
    assert all(abs(s - (5**0.5 - 1) / 2) < 1e-6 for s in steps)


def test_ratio_of_the_models_equals_brute_force(spark, docs, rng):
    """Counts of transitions and the ratio of every word, recomputed character by character."""
    from math import log

    texts = [prose(rng, 30) + f" secret={rng.randrange(10**14):x}Zz{i} snake_case_{i} {rng.randrange(16**11):x}" for i in range(40)]
    model = secrets.fit(docs(*texts, texts[0], None, ""))
    state = lambda c: secrets._ALPHABET.find(c) if c in secrets._ALPHABET else secrets.STATES - 1
    counts = {"secret": Counter(), "ordinary": Counter()}
    for text in (*texts, texts[0]):
        spans = secrets.base_spans(text)
        inside = [text[s[3] : s[2]] for s in spans]
        rest = "".join("\0" if any(s[1] <= i < s[2] for s in spans) else c for i, c in enumerate(text))
        words = [w for w in re.findall(r"[A-Za-z0-9+/_=-]+", rest) if len(w) >= 4]
        for kind, found in (("secret", inside), ("ordinary", words)):
            joined = [state(c) for c in "\n".join(found)]
            counts[kind].update(zip(joined, joined[1:], strict=False))
    plain = np.zeros(secrets.STATES**2)
    for (a, b), n in counts["ordinary"].items():
        plain[a * secrets.STATES + b] = n
    ordinary = secrets.identifiers(plain).reshape(secrets.STATES, -1)
    secret = np.zeros_like(ordinary)
    for (a, b), n in counts["secret"].items():
        secret[a, b] = n

    def ratio(word):
        path = [secrets.STATES - 1, *map(state, word), secrets.STATES - 1]
        chance = lambda t, a, b: log((t[a, b] + 1) / (t[a].sum() + secrets.STATES))
        return sum(chance(secret, a, b) - chance(ordinary, a, b) for a, b in zip(path, path[1:], strict=False))

    words = ["abcdefg", "snake_case_word", *[f"{rng.randrange(16**n):x}" for n in range(8, 30)], *(prose(rng, 30).split())]
    for word, found in zip(words, model.find(words), strict=True):
        whole = ratio(word)
        if min(abs(whole - model.least_total), abs(whole - model.least_mean * (len(word) + 1))) > 1e-6:
            assert found == (whole >= model.least_total and whole >= model.least_mean * (len(word) + 1))


def test_names_put_together_of_known_words_are_no_secrets(spark, docs, rng):
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    letters = "eeeeettttaaaaooonnnsssrrriihhddlluucmfywgpbvkxqjz"  # about as in prose
    texts = [prose(rng, 60, letters) + " token=" + "".join(rng.choice(alphabet) for _ in range(60)) for _ in range(300)]
    model = secrets.fit(docs(*texts))
    own = prose(rng, 400, letters).split()
    names = ["".join(w.capitalize() for w in own[i : i + 4]) for i in range(0, 80, 4)] + ["_".join(own[i : i + 4]) for i in range(80, 160, 4)]
    names += ["/".join(own[i : i + 5]) for i in range(160, 240, 5)] + ["_".join(own[i : i + 3]).upper() for i in range(240, 300, 3)]
    names += [own[300] + "-" * 20, "2024-01-01-" + own[301], "=" * 30]
    assert model.find(names).mean() < 0.05
    assert model.find(["".join(rng.choice(alphabet) for _ in range(32)) for _ in range(200)]).mean() > 0.9


def test_rests_of_words_and_many_secrets_in_one_text(spark, docs, rng):
    covered = secrets.Covered([("hex", 3, 6), ("assign", 5, 9), ("hex", 9, 10), ("hex", 20, 25)])
    for begin, end in ((0, 30), (3, 10), (4, 22), (10, 20), (12, 14), (25, 26), (0, 3)):
        free = [i for i in range(begin, end) if not (3 <= i < 10 or 20 <= i < 25)]
        assert [i for b, e in covered.rests(begin, end) for i in range(b, e)] == free and all(b < e for b, e in covered.rests(begin, end))

    def seconds(n):
        text = " ".join(f"{rng.randrange(16**32):032x} averyveryverylongword" for _ in range(n))
        began = time.process_time()
        where = secrets.Covered(secrets.base_spans(text))
        assert sum(1 for m in secrets._WORD.finditer(text) for _ in where.rests(*m.span())) == n
        return time.process_time() - began

    seconds(1000)
    assert seconds(32_000) < 40 * max(seconds(4000), 0.01)
