"""Benchmark decontamination: a prefix-filtered set join of item windows with document words.

Every benchmark window (``window`` consecutive item words; a shorter item is one
window) is a set whose tokens are ordered by their rarity in the corpus. As a
window must be contained whole, its necessary prefix is its rarest token. The
join meets a document where it has such a token; the token's position bounds
where the window would begin and end, the document's length must allow it, and
only then are all words of the window compared, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored
from retailloom.llm.text import PLAIN_WORDS, U64, Words, list_column, ranges, slices

_SEPARATOR = b"\x00"
_RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("finish", pa.int64())]))


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """A 16-bit prefilter: whether any of the hashes has these low bits."""
    seen = np.zeros(1 << 16, bool)
    seen[(hashes & U64(0xFFFF)).astype(np.int64)] = True
    return seen


def _vocabulary(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for _, _, data, at in slices(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(Words(data, at, PLAIN_WORDS).hash).view(np.int64))], ["word"])


def word_counts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(word, n): how often each word of the benchmark, by hash, occurs in all of ``docs``; unseen words are left out.

    Each task counts its own words first, so what is shuffled is bounded by the
    benchmark's vocabulary. That vocabulary is sent to the tasks in blocks of a
    million words; a larger one takes a pass over the texts for each block.
    """
    spark = ready(docs.sparkSession)
    words = benchmark.select("text").mapInArrow(_vocabulary, "word long").distinct()
    found = None
    for block in _blocks(words.orderBy("word"), 1_000_000):
        sent = spark.sparkContext.broadcast(block)

        def count(batches, sent=sent):
            wanted = np.sort(sent.value["word"].astype(np.int64).view(U64))
            seen, total = _bitmap(wanted), np.zeros(len(wanted), np.int64)
            for batch in batches:
                for _, _, data, at in slices(batch.column(0)):
                    own = Words(data, at, PLAIN_WORDS).hash
                    own = own[seen[(own & U64(0xFFFF)).astype(np.int64)]]
                    place = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                    total += np.bincount(place[wanted[place] == own], minlength=len(wanted))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], ["word", "n"])

        part = docs.select("text").mapInArrow(count, "word long, n long")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _blocks(df: DataFrame, rows: int) -> Iterator[dict[str, np.ndarray]]:
    """The rows in blocks of at most ``rows``, one block on the driver at a time."""
    held: list = []
    for row in df.toLocalIterator():
        held.append(row)
        if len(held) == rows:
            yield {c: np.array([r[i] for r in held]) for i, c in enumerate(df.columns)}
            held = []
    if held:
        yield {c: np.array([r[i] for r in held]) for i, c in enumerate(df.columns)}


def _windows(size: int):
    def run(batches):
        for batch in batches:
            for first, _, data, at in slices(batch.column(1)):
                words = Words(data, at, PLAIN_WORDS)
                items, n, word, offset, content = [], [], [], [], []
                for row in range(len(at) - 1):
                    count, low = int(words.count[row]), int(words.first[row])
                    texts = [words.folded[words.begin[low + i] : words.end[low + i]].tobytes() for i in range(count)]
                    for start in range(max(1, count - size + 1) if count else 0):
                        length = min(size, count)
                        for j in range(length):
                            items.append(batch.column(0)[first + row].as_py())
                            n.append(length)
                            word.append(int(words.hash[low + start + j].view(np.int64)))
                            offset.append(j)
                            content.append(_SEPARATOR.join(texts[start : start + length]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(n, pa.int32()), pa.array(word, pa.int64()),
                     pa.array(offset, pa.int32()), pa.array(content, pa.binary())], ["item_id", "n", "word", "offset", "content"])

    return run


def prefixes(benchmark: DataFrame, counts: DataFrame, window: int = 13) -> DataFrame:
    """One row per different window and item: its words, and the hash and offset of its rarest word.

    Rarity is the count over the corpus; a word never seen there is rarest, and
    such a window can match nothing, so it is left out. Ties go to the earlier word.
    """
    spread = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null").mapInArrow(
        _windows(window), "item_id long, n int, word long, offset int, content binary")
    rare = spread.join(counts.withColumnRenamed("n", "seen"), "word", "left").groupBy("item_id", "content", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "word")).alias("first"))
    return rare.where("first.seen > 0").select("item_id", "content", "n", F.col("first.offset").alias("offset"), F.col("first.word").alias("word"))


def _probe(sent, fields: list[str], has_found: bool):
    """Adds to each document the words hit and the items found by one block of prefixes."""

    def run(batches):
        block = sent.value
        order = np.argsort(block["word"].astype(np.int64).view(U64), kind="stable")
        token = block["word"].astype(np.int64).view(U64)[order]
        offset, length, item = (block[c].astype(np.int64)[order] for c in ("offset", "n", "item_id"))
        content, seen = [bytes(block["content"][i]) for i in order], _bitmap(token)
        at_text = fields.index("text")
        for batch in batches:
            sizes, runs, items = [], [], []
            for first, _, data, at in slices(batch.column(at_text)):
                words = Words(data, at, PLAIN_WORDS)
                at_word = np.flatnonzero(seen[(words.hash & U64(0xFFFF)).astype(np.int64)])
                own = words.hash[at_word]
                which, entry = ranges(np.searchsorted(token, own, "left"), np.searchsorted(token, own, "right"))
                begin = at_word[which] - offset[entry]
                row = words.row[at_word[which]]
                # Positional bound: the window begins within the document; length bound: it also ends there.
                fits = (begin >= words.first[row]) & (begin + length[entry] <= words.first[row] + words.count[row])
                spans: dict[int, list[tuple[int, int]]] = {}
                met: dict[int, set[int]] = {}
                for r, b, e in zip(row[fits].tolist(), begin[fits].tolist(), entry[fits].tolist(), strict=True):
                    end = b + int(length[e])
                    here = _SEPARATOR.join(words.folded[x:y].tobytes() for x, y in zip(words.begin[b:end], words.end[b:end], strict=True))
                    if here == content[e]:
                        spans.setdefault(r, []).append((b - int(words.first[r]), end - int(words.first[r])))
                        met.setdefault(r, set()).add(int(item[e]))
                for r in range(len(at) - 1):
                    before = first + r
                    old_runs = batch.column("runs")[before].as_py() if has_found else []
                    old_items = batch.column("items")[before].as_py() if has_found else []
                    joined = _merged([*((s["begin"], s["finish"]) for s in old_runs), *spans.get(r, [])])
                    runs.append([{"begin": b, "finish": e} for b, e in joined])
                    items.append(sorted({*old_items, *met.get(r, ())}))
                sizes.append(words.count)
            kept = [batch.column(f) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64()), pa.array(runs, _RUNS), pa.array(items, pa.list_(pa.int64()))],
                [*fields, "n_words", "runs", "items"])

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(set(spans)):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_rows: int = 200_000) -> DataFrame:
    """Adds ``n_words``, ``runs`` (where hit words begin and finish) and ``items`` (found item ids) to every document.

    The prefixes are sent to the tasks in blocks of at most ``block_rows`` windows;
    one pass over the texts serves a block, and a benchmark of more blocks takes
    more passes. Documents are never shuffled, so no hot document or word matters.
    NULL texts have no words. Repeated documents are judged each; repeated items
    count once. Items without an id or a word find nothing. An empty benchmark
    leaves every document clean. Columns of the added names are replaced.
    """
    spark = ready(docs.sparkSession)
    added = ("n_words", "runs", "items")
    fields = [c for c in docs.columns if c not in added]
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in fields) + ", n_words long, runs array<struct<begin:bigint,finish:bigint>>, items array<bigint>"
    found = stored(prefixes(benchmark, word_counts(docs, benchmark), window), "prefixes")
    out, again = docs.select(*fields), False
    empty = {"item_id": np.zeros(0, np.int64), "content": np.zeros(0, object), "n": np.zeros(0, np.int64), "offset": np.zeros(0, np.int64), "word": np.zeros(0, np.int64)}
    blocks = _blocks(found.orderBy("word", "item_id"), block_rows)
    for block in blocks:
        out = out.mapInArrow(_probe(spark.sparkContext.broadcast(block), fields, again), schema)
        again = True
    return out if again else out.mapInArrow(_probe(spark.sparkContext.broadcast(empty), fields, False), schema)


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated): a document is contaminated if a ``share``-th of its words is hit."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["finish"] - run["begin"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    counted = found.select("*", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))
