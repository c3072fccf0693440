"""Ranked lexical search by pipelined term partitioning.

The corpus is indexed in segments of some thousand documents. Every term of the
items has an owner: a band of document frequencies, rarest first. A bundle is one
item on its way through one segment. It holds a sparse accumulator of document
scores and passes from owner to owner; at each stop a cogroup brings it together with
the postings which that owner holds for the segment, and whole-number contributions
are added. The last owner selects the best of the segment, and a final selection
merges the segments of an item.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored
from retailloom.llm.text import PLAIN_WORDS, slices
from retailloom.llm.vocab import Coded, bitmap, unified

KEPT = PLAIN_WORDS != 0
BITS = 24
#: Shares of the documents up to which a term belongs to the first, second and third owner; the last one has the rest.
BANDS = (0.001, 0.01, 0.1)
_INDEX = "segment long, term string, ids array<long>, tf array<int>, n array<int>"
_BUNDLE = "segment long, block int, item long, pos array<int>, score array<long>, owner array<int>, tid array<long>, w array<long>, rest array<long>"
_BEST = "item long, doc_id long, score long"


def terms_of(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item; rows that share an item_id are one item."""
    # NULL texts have no terms; the pattern is that of a term, with only A-Z lowered.
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    return items.select("item_id", F.explode(F.array_distinct(found)).alias("term")).distinct()


class _Segment:
    """Postings of the wanted terms in the documents gathered so far."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.n: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, pa.Array]] = []
        self.pos: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.postings = 0

    def add(self, ids: list[int | None], data: np.ndarray, at: np.ndarray, mask: np.ndarray) -> None:
        words = Coded(data, at, KEPT)
        # A word's place in the bitmap; a false hit is dropped when its term meets no item.
        place = np.fromiter((zlib.crc32(v) for v in words.values.cast(pa.large_binary()).to_pylist()), np.int64, len(words.values)) % (1 << BITS)
        wanted = (mask[place >> 5] >> (place & 31).astype(np.uint32) & 1).astype(bool)
        code = np.full(len(wanted), -1, np.int64)
        code[wanted] = np.arange(int(wanted.sum()))
        own = code[words.codes]
        met, tf = np.unique(own[own >= 0] * len(ids) + words.row[own >= 0], return_counts=True)
        self.parts.append((met // len(ids), words.values.filter(pa.array(wanted))))
        self.pos.append(met % len(ids) + len(self.ids))
        self.tf.append(tf)
        self.n.append(np.bincount(words.row, minlength=len(ids)))
        self.ids += ids
        self.postings += len(met)

    def rows(self, segment: int) -> pa.RecordBatch:
        codes, values = unified(self.parts)
        code, pos, tf, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (codes, self.pos, self.tf, self.n))
        order = np.lexsort((pos, code))
        code, pos, tf = code[order], pos[order], tf[order]
        present, sizes = np.unique(code, return_counts=True)
        ends = np.cumsum([0, *sizes, 0]).astype(np.int32)
        last = np.append(ends[:-1], ends[-2] + len(self.ids)).astype(np.int32)
        term = pa.concat_arrays([values.take(pa.array(present)).cast(pa.string()), pa.nulls(1, pa.string())])
        ids = pa.concat_arrays([pa.array(pos, pa.int64()), pa.array(self.ids, pa.int64())])
        lists = [pa.ListArray.from_arrays(pa.array(last), ids)]
        lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(tf, pa.int32())))
        lists.append(pa.ListArray.from_arrays(pa.array(last), pa.array(np.concatenate([n[pos], n]), pa.int32())))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(term), segment, np.int64)), term, *lists], ["segment", "term", "ids", "tf", "n"])


def _indexed(sent, docs_per_segment: int, postings_per_segment: int):
    def run(batches: Iterator[pa.RecordBatch]):
        mask, held, made = sent.value, _Segment(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, end, data, at in slices(batch.column(1)):
                held.add(ids[first:end], data, at, mask)
                if len(held.ids) >= docs_per_segment or held.postings >= postings_per_segment:
                    yield held.rows(made)
                    held, made = _Segment(), made + 1
        if held.ids:
            yield held.rows(made)

    return run


def index(docs: DataFrame, terms: DataFrame, docs_per_segment: int = 8192, postings_per_segment: int = 2_000_000) -> DataFrame:
    """Postings of ``terms`` (one column ``term``) in segments, stored: (segment, term, ids, tf, n).

    A term's row lists the positions of its documents in the segment, its
    occurrences and the documents' lengths in terms; the segment's row without a
    term lists the doc_ids and lengths of all its documents. Texts never leave their task.
    """
    spark = ready(docs.sparkSession)
    sent = spark.sparkContext.broadcast(bitmap(terms, "term", BITS))  # 2 MB at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_indexed(sent, docs_per_segment, postings_per_segment), _INDEX), "postings")


def _stop(owner: int, last: bool, k: int, docs: int, tokens: int):
    """One owner's work on the bundles of a segment and a block of items."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        ids = np.zeros(0, np.int64)
        missing = np.zeros(0, bool)
        size = 0
        for tid, at, tf, n in zip(*(postings.column(c).to_pylist() if c == "tid" else postings.column(c) for c in ("tid", "ids", "tf", "n")), strict=True):
            if tid is None:
                missing = at.values.is_null().to_numpy(zero_copy_only=False)
                ids = at.values.fill_null(0).to_numpy()
                continue
            pos, tf, n = at.values.to_numpy(), tf.values.to_numpy().astype(np.int64), n.values.to_numpy().astype(np.int64)
            m = 10 + 90 * n * docs // tokens
            held[tid] = pos, 1_000_000_000 * tf // (1000 * tf + 8 * m)
            size = max(size, int(pos.max()) + 1)
        out: dict[str, list] = {"pos": [], "score": []}
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in range(bundles.num_rows):
            pos, score, owners, tids, weights, rest = (bundles.column(c)[i].values.to_numpy() for c in ("pos", "score", "owner", "tid", "w", "rest"))
            dense = np.zeros(max(size, int(pos.max()) + 1 if len(pos) else 0), np.int64)
            dense[pos] = score
            for tid, w in zip(tids[owners == owner].tolist(), weights[owners == owner].tolist(), strict=True):
                if tid in held:
                    dense[held[tid][0]] += w * held[tid][1]
            pos = np.flatnonzero(dense)
            score = dense[pos]
            if len(pos) > k:
                # A document that cannot reach the k-th best even with all that later owners may add is not carried on.
                floor = np.partition(score, len(score) - k)[len(score) - k]
                pos = pos[score + rest[owner] >= floor]
                score = dense[pos]
            if not last:
                out["pos"].append(pos)
                out["score"].append(score)
                continue
            order = np.lexsort((ids[pos], missing[pos], -score))[:k]
            best.append((np.full(len(order), bundles.column("item")[i].as_py(), np.int64), pos[order], score[order]))
        if last:
            item, pos, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*best, strict=True) if best else ([], [], [])))
            return pa.table({"item": pa.array(item, pa.int64()), "doc_id": pa.array(ids[pos], pa.int64(), mask=missing[pos]), "score": pa.array(score, pa.int64())})
        for name, kind in (("pos", pa.int32()), ("score", pa.int64())):
            ends = np.cumsum([0, *map(len, out[name])]).astype(np.int32)
            values = pa.array(np.concatenate(out[name]) if out[name] else np.zeros(0, np.int64)).cast(kind)
            at = bundles.schema.get_field_index(name)
            bundles = bundles.set_column(at, name, pa.ListArray.from_arrays(pa.array(ends), values))
        return bundles

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_items: int = 256, docs_per_segment: int = 8192) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest documents with a score above 0, ties to the smaller doc_id.

    Every segment of the index is met by every block of about ``block_items``
    items, so a task holds one segment's postings and one block's accumulators, however
    large the corpus, the item table or a term's list. Documents that share a doc_id are
    ranked each; those without one come last among equals. Rows of one item_id are one
    item, a NULL item_id included. NULL and empty texts hold no term; an item without
    terms, an empty corpus and an empty item table give no rows. Extra columns play no part.
    """
    spark = ready(docs.sparkSession)
    asked = stored(terms_of(items), "item-terms")
    numbered = _numbered(asked.select("item_id").distinct(), block_items)
    segments = index(docs, asked.select("term"), docs_per_segment)
    whole = segments.where("term is null")
    total = whole.agg(
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + (x > 0).cast("long"))).alias("docs"),
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x)).alias("tokens")).first()
    if not total.tokens:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    share = F.col("df") / F.lit(float(total.docs))
    owner = sum((F.when(share > b, 1).otherwise(0) for b in BANDS), F.lit(0))
    known = segments.where("term is not null").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum(F.size("ids").cast("long")).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total.docs + 2) / (2 * F.col("df") + 1)))
    terms = stored(known.select("term", F.monotonically_increasing_id().alias("tid"), owner.cast("int").alias("owner"), weight.cast("long").alias("w")), "terms")
    routed = stored(asked.join(numbered, F.col("item_id").eqNullSafe(F.col("known_id"))).join(terms, "term").select("item", "block", "term", "owner", "tid", "w"), "routes")

    count = len(BANDS) + 1
    # No contribution reaches a million times its weight, so this bounds what the owners after each can add.
    rest = F.array(*[F.sum(F.when(F.col("owner") > i, F.col("w") * 1_000_000).otherwise(0)) for i in range(count)])
    path = F.collect_list(F.struct("owner", "tid", "w"))
    routes = routed.groupBy("block", "item").agg(path.alias("path"), rest.alias("rest"))
    blocks = routed.select("block").distinct()
    met = whole.select("segment", F.explode(F.sequence(F.lit(0), F.lit(_blocks(numbered) - 1))).alias("block"))
    bundles = met.join(routes, "block").select(
        "segment", "block", "item", F.array().cast("array<int>").alias("pos"), F.array().cast("array<long>").alias("score"),
        F.col("path.owner").alias("owner"), F.col("path.tid").alias("tid"), F.col("path.w").alias("w"), "rest")
    wanted = routed.select("term", "tid", "owner", "block").distinct()
    held = segments.join(wanted, "term").select("segment", "block", "owner", "tid", "ids", "tf", "n")
    named = met.join(blocks, "block", "left_semi").join(whole.select("segment", "ids"), "segment").select(
        "segment", "block", F.lit(count - 1).alias("owner"), F.lit(None).cast("long").alias("tid"), "ids", F.array().cast("array<int>").alias("tf"), F.array().cast("array<int>").alias("n"))
    held = held.unionByName(named)
    for i in range(count):
        last = i == count - 1
        # toDF gives the columns identities of their own, as both sides come from the same table.
        here = held.where(F.col("owner") == i).toDF(*held.columns)
        bundles = bundles.groupBy("segment", "block").cogroup(here.groupBy("segment", "block")).applyInArrow(
            _stop(i, last, k, total.docs, total.tokens), _BEST if last else _BUNDLE)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(numbered, "item").select(F.col("known_id").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _numbered(ids: DataFrame, block_items: int) -> DataFrame:
    """(known_id, item, block): items numbered and dealt to blocks, stored so that the numbers stay."""
    count = ids.count()
    number = F.monotonically_increasing_id()
    return stored(ids.select(F.col("item_id").alias("known_id"), number.alias("item"), F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-count // block_items)))).cast("int").alias("block")), "items")


def _blocks(numbered: DataFrame) -> int:
    return (numbered.agg(F.max("block")).first()[0] or 0) + 1
