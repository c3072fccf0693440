"""Phrase collocation mining with counting quotient filters.

Words get whole-number ids of b bits. An n-gram of ids is packed into n * b bits,
which an invertible permutation scrambles; the upper b bits are its quotient, the rest its
full remainder, so a counter holds the n-gram without loss. A filter is the
counters in order of quotient and remainder, written as gaps of quotients,
remainders of as many bytes as they need, and counts. Shards count their texts into filters; the
filters of a range of quotients are merged as sorted lists, and what has been
counted often enough is unpacked into ids and words again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored
from retailloom.llm.text import U64, mix, salt, slices
from retailloom.llm.vocab import Coded, unified

_PIECE_ENDS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E)))
_KEPT = ~_PIECE_ENDS & ~np.isin(np.arange(256), [0x20, 0x09])
_ROUNDS = 4
#: Ids have at most so many bits, so that the remainder of three fits 64.
ID_BITS = 32

# A reader holds whole row groups, so a shard is one of its own.
_ONE_BY_ONE = {"parquet.block.row.count.limit": "1"}

_SHARD = "shard long, lang string, words array<string>, counts array<long>, codes array<int>"
_FILTER = "lang string, size int, part int, slots long, gaps binary, gap_more array<long>, remainders binary, counts binary, count_more array<long>"
_COUNTED = "lang string, size int, first long, second long, third long, a long"


# --- shards of coded words ----------------------------------------------------------------


class _Shard:
    """Words of one language as codes; a break stands wherever two words are not neighbours in one piece."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, pa.Array]] = []
        self.breaks: list[np.ndarray] = []
        self.bytes = 0

    def add(self, data: np.ndarray, at: np.ndarray) -> None:
        words = Coded(data, at, _KEPT)
        ends = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_PIECE_ENDS[data], out=ends[1:])
        apart = np.ones(len(words.begin), bool)
        apart[1:] = (words.row[1:] != words.row[:-1]) | (ends[words.begin[1:]] != ends[words.begin[:-1]])
        self.parts.append((words.codes, words.values))
        self.breaks.append(apart)
        self.bytes += len(data)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        codes, values = unified(self.parts)
        code, apart = np.concatenate(codes), np.concatenate(self.breaks)
        counts = np.bincount(code, minlength=len(values))
        # Codes from 1; 0 is a break, put in front of each word that begins a piece.
        with_breaks = np.zeros(len(code) + int(apart.sum()), np.int32)
        with_breaks[np.arange(len(code)) + np.cumsum(apart)] = code + 1
        one = lambda x: pa.array([x])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (
            values.cast(pa.string()), pa.array(counts, pa.int64()), pa.array(with_breaks, pa.int32()))]
        return pa.RecordBatch.from_arrays([one(shard), one(lang), *lists], ["shard", "lang", "words", "counts", "codes"])


def _sharded(limit: int):
    def run(batches: Iterator[pa.RecordBatch]):
        made = TaskContext.get().partitionId() << 32
        held: dict[str, _Shard] = {}
        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column(0).filter(pa.array(langs.indices.to_numpy() == code))
                for _, _, data, at in slices(texts):
                    held.setdefault(lang, _Shard()).add(data, at)
                    if held[lang].bytes >= limit:
                        yield held.pop(lang).row(made, lang)
                        made += 1
            # Many languages side by side hold no more than a few full shards do.
            if sum(s.bytes for s in held.values()) >= 4 * limit:
                for lang in list(held):
                    yield held.pop(lang).row(made, lang)
                    made += 1
        for lang in list(held):
            yield held.pop(lang).row(made, lang)
            made += 1

    return run


def _numbered(parts: int):
    """Ids that stay dense: the k-th word of part p of ``parts`` is number k * parts + p + 1."""

    def run(part: pa.Table) -> pa.Table:
        ids = np.arange(part.num_rows, dtype=np.int64) * parts + part.column("part")[0].as_py() + 1
        return part.select(["lang", "word", "f"]).append_column("id", pa.array(ids))

    return run


# --- counting quotient filters ------------------------------------------------------------


def _low(bits: int) -> np.uint64:
    return U64((1 << bits) - 1)


def permuted(quotient: np.ndarray, remainder: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """An invertible scrambling of (quotient, remainder) of ``bits`` bits each, by rounds that alter one half by the other."""
    for r in range(_ROUNDS):
        remainder = remainder ^ (mix(quotient ^ salt(2 * r)) & _low(bits[1]))
        quotient = quotient ^ (mix(remainder ^ salt(2 * r + 1)) & _low(bits[0]))
    return quotient, remainder


def restored(quotient: np.ndarray, remainder: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permuted``."""
    for r in reversed(range(_ROUNDS)):
        quotient = quotient ^ (mix(remainder ^ salt(2 * r + 1)) & _low(bits[0]))
        remainder = remainder ^ (mix(quotient ^ salt(2 * r)) & _low(bits[1]))
    return quotient, remainder


def tallied(quotient: np.ndarray, remainder: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counters in order, equal ones added: how filters are filled and merged."""
    order = np.lexsort((remainder, quotient))
    quotient, remainder, count = quotient[order], remainder[order], count[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (quotient[1:] != quotient[:-1]) | (remainder[1:] != remainder[:-1])
    at = np.flatnonzero(fresh)
    return quotient[at], remainder[at], np.add.reduceat(count, at) if len(at) else count


def _short(values: np.ndarray) -> tuple[bytes, list[int]]:
    """One byte a value; 255 stands for the next of the larger ones kept apart."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes(), values[large].astype(np.int64).tolist()


def _long(raw: bytes, more: list[int]) -> np.ndarray:
    values = np.frombuffer(raw, np.uint8).astype(np.int64)
    values[values == 255] = more
    return values


def written(quotient: np.ndarray, remainder: np.ndarray, count: np.ndarray, bits: int) -> tuple:
    """A filter of counters in order: (slots, gaps, gap_more, remainders, counts, count_more)."""
    width = max(1, -(-bits // 8))
    gaps = np.diff(quotient.astype(np.int64), prepend=0)
    raw = remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return (len(quotient), *_short(gaps), np.ascontiguousarray(raw).tobytes(), *_short(count))


def read(slots: int, gaps: bytes, gap_more: list[int], remainders: bytes, counts: bytes, count_more: list[int], bits: int) -> tuple:
    """The counters of a filter: (quotient, remainder, count)."""
    wide, width = np.zeros((slots, 8), np.uint8), max(1, -(-bits // 8))
    wide[:, :width] = np.frombuffer(remainders, np.uint8).reshape(slots, width)
    return np.cumsum(_long(gaps, gap_more)).astype(U64), wide.reshape(-1).view("<u8").astype(U64), _long(counts, count_more)


def _grams(ids: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder, not scrambled yet, of every run of ``size`` ids without a break."""
    ids = ids.astype(U64)
    n = max(0, len(ids) - size + 1)
    whole = np.ones(n, bool)
    for j in range(size):
        whole &= ids[j : j + n] != 0
    rest = ids[1 : 1 + n].copy()
    for j in range(2, size):
        rest = rest << U64(bits) | ids[j : j + n]
    return ids[:n][whole], rest[whole]


def _filled(bits: int, parts: int, largest: int, slots: int):
    """Counts shards into filters; a task adds its shards together until ``slots`` counters are held, then cuts them by ranges of quotients."""

    def rows(lang: str, size: int, filters: list[tuple]) -> Iterator[pa.RecordBatch]:
        quotient, remainder, count = tallied(*(np.concatenate(x) for x in zip(*filters, strict=True)))
        cuts = np.searchsorted(quotient, np.array([-(-(p << bits) // parts) for p in range(parts)], U64)).tolist() + [len(quotient)]
        made = [(lang, size, p, *written(quotient[a:b], remainder[a:b], count[a:b], bits * (size - 1)))
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        for first in range(0, len(made), 64):
            yield _batch(made[first : first + 64], _FILTER)

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[tuple[str, int], list[tuple]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                lang, codes = batch.column(0)[i].as_py(), batch.column(1)[i].values.to_numpy()
                table = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
                table[batch.column(2)[i].values.to_numpy()] = batch.column(3)[i].values.to_numpy()
                ids = table[codes]
                for size in range(2, largest + 1):
                    scrambled = permuted(*_grams(ids, size, bits), (bits, bits * (size - 1)))
                    held.setdefault((lang, size), []).append(tallied(*scrambled, np.ones(len(scrambled[0]), np.int64)))
                if sum(len(f[0]) for filters in held.values() for f in filters) >= slots:
                    for key in list(held):
                        yield from rows(*key, held.pop(key))
        for key in list(held):
            yield from rows(*key, held.pop(key))

    return run


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def _merged(bits: int, least: int):
    """Merges the filters of one language, size and range of quotients; unpacks what was counted ``least`` times."""

    def run(table: pa.Table) -> pa.Table:
        lang, size = table.column("lang")[0].as_py(), table.column("size")[0].as_py()
        width = (bits, bits * (size - 1))
        names = ["slots", "gaps", "gap_more", "remainders", "counts", "count_more"]
        filters = [read(*row, width[1]) for row in zip(*(table.column(n).to_pylist() for n in names), strict=True)]
        quotient, remainder, count = tallied(*(np.concatenate(x) for x in zip(*filters, strict=True)))
        often = count >= least
        first, rest = restored(quotient[often], remainder[often], width)
        ids = [first] + [rest >> U64(bits * (size - 2 - j)) & _low(bits) for j in range(size - 1)]
        columns = [pa.array(x.astype(np.int64)) for x in ids] + [pa.nulls(len(first), pa.int64())] * (3 - size)
        n = len(first)
        return pa.table([pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), *columns, pa.array(count[often])], ["lang", "size", "first", "second", "third", "a"])

    return run


# --- the operator -------------------------------------------------------------------------


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of 38 digits; counts up to 10^15 fit."""
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    top = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def phrases(docs: DataFrame, least: int = 10, shard_bytes: int = 4 << 20, merge_slots: int = 2_000_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counted, words, totals): frequent n-grams of ids, the frequent words with their ids and counts, and all words per language.

    Every occurrence in every text is counted. A phrase of a word seen fewer than
    ``least`` times cannot reach ``least`` itself, so such words only end runs. A task holds one
    shard of about ``shard_bytes`` of text (a longer single text is a shard of its own), or
    filters of about ``merge_slots`` counters; there are as many ranges of quotients as that takes.
    """
    spark = ready(docs.sparkSession)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    shards = stored(texts.mapInArrow(_sharded(shard_bytes), _SHARD), "shards", **_ONE_BY_ONE)
    pairs = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = pairs.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    totals = stored(shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")), "totals")
    frequent = counted.where(F.col("f") >= least)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = stored(frequent.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts))).groupBy("part").applyInArrow(
        _numbered(parts), "lang string, word string, f long, id long"), "words")
    bits = max(1, (words.agg(F.max("id")).first()[0] or 1).bit_length())
    if bits > ID_BITS:
        raise ValueError(f"{bits} bits of word ids; the remainders of three hold {ID_BITS} each")
    largest = totals.agg(F.max("n")).first()[0] or 0
    ranges = max(1, math.ceil(largest / merge_slots))

    places = shards.select("shard", "lang", F.posexplode("words").alias("place", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    known = places.groupBy("shard").agg(F.collect_list(F.struct((F.col("place") + 1).alias("place"), "id")).alias("known"))
    coded = shards.join(known, "shard").select("lang", "codes", F.col("known.place").alias("place"), F.col("known.id").alias("id"))
    filters = coded.mapInArrow(_filled(bits, ranges, 3, merge_slots), _FILTER)
    grams = stored(filters.groupBy("lang", "size", "part").applyInArrow(_merged(bits, least), _COUNTED), "grams")
    return grams, words, totals


def collocations(docs: DataFrame, least: int = 10, share: int = 50, best: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases of two or three words.

    Phrases seen ``least`` times are candidates; the cut with the lowest score
    counts, the earlier one among equals. A pair within any triple that has
    ``share`` percent of its count is left out. NULL texts are empty, NULL languages are
    ``und``, repeated rows count each, very long texts are read whole; an empty table gives no rows.
    """
    grams, words, totals = phrases(docs, least)
    word = words.select("lang", F.col("id"), "word", "f")

    def named(df: DataFrame, column: str, as_word: str, as_f: str) -> DataFrame:
        return df.join(word.select("lang", F.col("id").alias(column), F.col("word").alias(as_word), F.col("f").alias(as_f)), ["lang", column])

    pairs = grams.where("size = 2").select("lang", "first", "second", "a")
    triples = grams.where("size = 3").select("lang", "first", "second", "third", "a")
    inside = triples.select("lang", "first", "second", "a").unionByName(triples.select("lang", F.col("second").alias("first"), F.col("third").alias("second"), "a"))
    longest = inside.groupBy("lang", "first", "second").agg(F.max("a").alias("longer"))
    kept = pairs.join(longest, ["lang", "first", "second"], "left").where(F.coalesce(F.lit(100) * F.col("longer") < share * F.col("a"), F.lit(True)))
    kept = named(named(kept.drop("longer"), "first", "w1", "l"), "second", "w2", "r")
    kept = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r").withColumn("score", _score("a", "l", "r"))

    head = pairs.select("lang", "first", "second", F.col("a").alias("l2"))
    tail = pairs.select("lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("r1"))
    cut = triples.join(head, ["lang", "first", "second"]).join(tail, ["lang", "second", "third"])
    cut = named(named(named(cut, "first", "w1", "l1"), "second", "w2", "f2"), "third", "w3", "r2")
    cut = cut.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    cut = cut.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                     *[F.when(early, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(n) for c, n in (("l", "l"), ("r", "r"), ("s", "score"))])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    found = kept.unionByName(cut)
    # The best of every part of a language first, so that no task gathers all its phrases.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))))
    top = few.where(F.col("rank") <= best).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
