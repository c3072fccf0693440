"""N-gram Jaccard self-join by chosen paths.

Every document is the set of its runs of five words, as 48-bit hashes. Documents
with equal sets form one class first, so exact copies never meet in pairs.

A run gives each set a small tree: the root samples about ``breadth / similarity``
of its tokens, each sampled token a next level, and so on, by a hash of the path,
so two sets that share the sampled tokens share the path. Sets that share a whole
path form a bucket: each level splits it by one more shared token, which parts
sets that have a passage in common and little else. Small buckets are compared by brute
force. Runs are repeated until a pair at the bound is met with the target probability.

A bucket that is still large holds near copies, which further levels would not part. Its
members are first compared with one pivot; those very like it need no comparison
among each other or with the rest, as whoever is similar to them is like the pivot too, and
what is left is taken on in further rounds with other pivots. So a group of n near copies
costs a few rows per member here, not one per pair.

Buckets compare sketches, whose bound lies five deviations below the similarity,
and pass on only a star of each linked cluster. The clusters' documents are then
compared exactly, each pair once, in blocks; counts of links leave the tasks, never
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailloom.llm.shared import components, ready, stored
from retailloom.llm.text import PLAIN_WORDS, U64, Words, binary_column, list_column, mix, ranges, salt, shingles, slices

BINS = 128
_BITS = 24
# Estimated similarities to a pivot: at _CORE a member needs no comparison of its own, at _AROUND it may hang together with the pivot.
_CORE, _AROUND = 0.9, 0.45
_TOKEN_BITS = U64(48)
_TOKEN = U64((1 << 48) - 1)


def runs_needed(recall: float, breadth: float, depth: int) -> int:
    """How often to repeat so that a pair at the bound shares a bucket of the last level with this probability."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-breadth * meet)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def token_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of consecutive rows, each as row << 48 | token, and the number of tokens of each row."""
    row, value = shingles(Words(data, at, PLAIN_WORDS), size)
    keys = np.sort((row.astype(U64) << _TOKEN_BITS) | (value >> U64(16)))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys, np.bincount((keys >> _TOKEN_BITS).astype(np.int64), minlength=len(at) - 1)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def sketches(keys: np.ndarray, rows: int) -> np.ndarray:
    """One byte per row and bin: 0 for an empty bin, else a digest of the bin's smallest token."""
    out = np.zeros((rows, BINS), np.uint8)
    if len(keys):
        place = keys >> U64(41)
        first = np.concatenate([[True], place[1:] != place[:-1]])
        out.reshape(-1)[place[first].astype(np.int64)] = (mix(keys[first] & _TOKEN) % U64(255) + U64(1)).astype(np.uint8)
    return out


def paths(keys: np.ndarray, sizes: np.ndarray, similarity: float, breadth: float, depth: int, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) of every leaf of every tree, by row."""
    width = np.where(sizes > 0, np.minimum(1.0, breadth / (similarity * np.maximum(sizes, 1))), 0)
    span = np.minimum((width * float(1 << 48)).astype(U64) + U64(1), U64(1 << 48))
    row = np.tile(np.flatnonzero(sizes > 0), runs)
    node = np.repeat(np.array([salt(100 + r) for r in range(runs)], U64), int((sizes > 0).sum()))
    for _ in range(depth):
        # The tokens within ``span`` above a point named by the path, around the end if need be: one or two ranges.
        start, high = node >> U64(16), row.astype(U64) << _TOKEN_BITS
        stop = start + span[row]
        over = np.maximum(stop, U64(1 << 48)) - U64(1 << 48)
        stop = np.minimum(stop, U64(1 << 48))
        owner1, index1 = ranges(np.searchsorted(keys, high + start), np.searchsorted(keys, high + stop))
        owner2, index2 = ranges(np.searchsorted(keys, high), np.searchsorted(keys, high + np.minimum(over, start)))
        owner, index = np.concatenate([owner1, owner2]), np.concatenate([index1, index2])
        node, row = mix(node[owner] ^ mix(keys[index] & _TOKEN)), row[owner]
    order = np.argsort(row, kind="stable")
    return row[order], node[order]


def set_keys(keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that together name each row's set."""
    token = keys & _TOKEN
    return tuple(_sums(mix(token ^ salt(n)), sizes).view(np.int64) for n in (1, 2))


def _describe(size: int, similarity: float, breadth: float, depth: int, runs: int):
    def run(batches):
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, end, data, at in slices(batch.column(1)):
                with np.errstate(over="ignore"):
                    keys, sizes = token_sets(data, at, size)
                    key1, key2 = set_keys(keys, sizes)
                    row, path = paths(keys, sizes, similarity, breadth, depth, runs)
                leaves = np.bincount(row, minlength=end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(made + np.arange(end - first)), pa.array(key1), pa.array(key2), pa.array(sizes.astype(np.int64)), pa.array(np.diff(at)),
                     binary_column(sketches(keys, end - first)), list_column(path.view(np.int64), leaves, pa.int64())],
                    ["doc_id", "row", "key1", "key2", "n_tokens", "n_bytes", "sketch", "paths"])
                made += end - first

    return run


def key_bits(rows: DataFrame) -> np.ndarray:
    """A bitmap of ``key1``, 2 MB however many there are: with very many it lets more rows through, and a join that follows drops them."""
    place = rows.select(F.expr(f"key1 & {(1 << _BITS) - 1}").alias("place"))
    pieces = place.groupBy(F.shiftright("place", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 31 as int))")).alias("mask")).toArrow()
    out = np.zeros(1 << _BITS >> 5, np.uint32)
    out[pieces["at"].to_numpy()] = pieces["mask"].to_numpy().astype(np.uint32)
    return out


def _keyed(sent, size: int, text_at: int, only_marked: bool):
    """Adds the keys of each row's set, and whether the bitmap has them; on demand passes on such rows only."""

    def run(batches):
        mask = sent.value
        for batch in batches:
            for first, end, data, at in slices(batch.column(text_at)):
                with np.errstate(over="ignore"):
                    keys, sizes = token_sets(data, at, size)
                    key1, key2 = set_keys(keys, sizes)
                place = key1 & ((1 << _BITS) - 1)
                marked = (mask[place >> 5] >> (place & 31).astype(np.uint32) & 1).astype(bool) & (sizes > 0)
                rows = pa.RecordBatch.from_arrays(
                    [*batch.slice(first, end - first).columns, pa.array(key1), pa.array(key2), pa.array(marked)], [*batch.schema.names, "key1", "key2", "marked"])
                yield rows.filter(pa.array(marked)) if only_marked else rows

    return run


def with_keys(docs: DataFrame, bits: np.ndarray, size: int = 5, only_marked: bool = False) -> DataFrame:
    """``docs`` with ``key1``, ``key2`` and ``marked``: whether the set's key is in the bitmap. Texts stay in their tasks."""
    spark = ready(docs.sparkSession)
    types = {f.name: f.dataType for f in docs.schema}
    added = T.StructType.fromDDL("key1 long, key2 long, marked boolean")
    schema = T.StructType([*(T.StructField(c, types[c]) for c in docs.columns), *added])
    return docs.mapInArrow(_keyed(spark.sparkContext.broadcast(bits), size, docs.columns.index("text"), only_marked), schema)


def _grouped(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows of a sorted partition, a batch's worth of them at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1].as_py() for c in by]
        same = np.ones(batch.num_rows, bool)
        for c, v in zip(by, last, strict=True):
            same &= batch.column(c).to_numpy(zero_copy_only=False) == v
        cut = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _segments(table: pa.Table, by: list[str]) -> np.ndarray:
    """Where groups begin in a sorted table, and its end."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for c in by:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's cluster under these links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _alike(a: np.ndarray, b: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two sketch blocks whose estimated similarity reaches the bound."""
    left, right = [], []
    step = max(1, (8 << 20) // max(1, len(b) * BINS))
    for low in range(0, len(a), step):
        part = a[low : low + step, None, :]
        filled = ((part | b[None]) != 0).sum(2)
        match = ((part == b[None]) & (part != 0)).sum(2)
        i, j = np.nonzero(match >= bound * np.maximum(filled, 1))
        left.append(i + low)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _compare_sketches(bound: float):
    by = ["bucket", "one", "two"]

    def run(batches):
        for table in _grouped(batches, by):
            at = _segments(table, by)
            rep, side = table.column("rep").to_numpy(), table.column("side").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            one, two = table.column("one").to_numpy(), table.column("two").to_numpy()
            a, b = [], []
            for low, high in zip(at[:-1], at[1:], strict=True):
                if high - low < 2:
                    continue
                if one[low] == two[low]:
                    i, j = _alike(sketch[low:high], sketch[low:high], bound)
                else:
                    here, there = np.flatnonzero(side[low:high] == one[low]), np.flatnonzero(side[low:high] == two[low])
                    i, j = _alike(sketch[low + here], sketch[low + there], bound) if len(here) and len(there) else (here[:0], there[:0])
                    i, j = here[i], there[j]
                own = i != j
                if own.any():
                    root = _roots(high - low, i[own], j[own])
                    moved = np.flatnonzero(root != np.arange(high - low))
                    a.append(rep[low + moved])
                    b.append(rep[low + root[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (a, b)], ["a", "b"])

    return run


def _shared(a: np.ndarray, b: np.ndarray, rows_a: int, rows_b: int) -> np.ndarray:
    """Number of common tokens of each row of one block and each of another; keys are row << 48 | token."""
    if a is b:
        vocabulary, times = np.unique(a & _TOKEN, return_counts=True)
        vocabulary = vocabulary[times > 1]
    else:
        vocabulary = np.intersect1d(a & _TOKEN, b & _TOKEN)
    total = np.zeros((rows_a, rows_b), np.float32)
    step = max(256, (4 << 20) // max(rows_a, rows_b, 1))
    place_a, place_b = (np.minimum(np.searchsorted(vocabulary, k & _TOKEN), max(0, len(vocabulary) - 1)) for k in (a, b))
    for low in range(0, len(vocabulary), step):
        dense = []
        for keys, place, rows in ((a, place_a, rows_a), (b, place_b, rows_b)):
            inside = (place >= low) & (place < low + step)
            inside[inside] = vocabulary[place[inside]] == keys[inside] & _TOKEN
            block = np.zeros((rows, min(step, len(vocabulary) - low)), np.float32)
            block[(keys[inside] >> _TOKEN_BITS).astype(np.int64), place[inside] - low] = 1
            dense.append(block)
        total += dense[0] @ dense[1].T
    return total


def _compare_sets(size: int, similarity: float):
    by = ["component", "one", "two"]

    def run(batches):
        for table in _grouped(batches, by):
            at = _segments(table, by)
            rep, copies, side = (table.column(c).to_numpy() for c in ("rep", "copies", "side"))
            one, two = table.column("one").to_numpy(), table.column("two").to_numpy()
            text = table.column("text").combine_chunks()
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for low, high in zip(at[:-1], at[1:], strict=True):
                sets = [token_sets(d, o, size) for _, _, d, o in slices(text.slice(low, high - low))]
                n = np.concatenate([s[1] for s in sets])
                shift = np.cumsum([0] + [len(s[1]) for s in sets])
                keys = np.concatenate([s[0] + (U64(k) << _TOKEN_BITS) for s, k in zip(sets, shift[:-1], strict=True)])
                here = np.flatnonzero(side[low:high] == one[low])
                there = np.flatnonzero(side[low:high] == two[low])
                part = []
                for rows in (here, there) if one[low] != two[low] else (here,):
                    number = np.full(high - low, -1, np.int64)
                    number[rows] = np.arange(len(rows))
                    own = number[(keys >> _TOKEN_BITS).astype(np.int64)]
                    part.append((own[own >= 0].astype(U64) << _TOKEN_BITS) | (keys[own >= 0] & _TOKEN))
                common = _shared(part[0], part[-1], len(here), len(there))
                union = n[here][:, None] + n[there][None] - common
                linked = common >= similarity * union - 1e-6
                if one[low] == two[low]:
                    np.fill_diagonal(linked, False)
                links = np.zeros(high - low, np.int64)
                links[here] += linked @ copies[low + there]
                if one[low] != two[low]:
                    links[there] += linked.T @ copies[low + here]
                i, j = np.nonzero(linked)
                root = _roots(high - low, here[i], there[j])
                kept = np.flatnonzero(links > 0)
                found.append((rep[low + kept], rep[low + root[kept]], links[kept]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found]), pa.int64()) for k in range(3)], ["a", "b", "links"])

    return run


def _in_blocks(rows: DataFrame, blocks, keep: list[str]) -> DataFrame:
    """Deals every member of a group to all pairs of its blocks: each two members of the group meet in one pair."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    dealt = rows.withColumn("blocks", blocks).withColumn("side", own.cast("long"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(*keep, "rep", "side", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"))


def _estimated(batches):
    """The estimated similarity of the two sketches of each row."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sketch", "other"))
        filled = np.maximum(((a | b) != 0).sum(1), 1)
        yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("pivot"), pa.array(((a == b) & (a != 0)).sum(1) / filled)], ["rep", "pivot", "alike"])


def _by_pivots(large: DataFrame, sketch: DataFrame, bucket: int, rounds: int) -> tuple[DataFrame | None, DataFrame]:
    """(links, (bucket, rep, n) still to be compared) of buckets of more than ``bucket`` members.

    A round compares every member with its bucket's pivot, the member first by hash, so
    that buckets of one group of copies agree on it and a pair is compared once. Members at ``_CORE`` or more leave the bucket:
    whoever is similar to them is, by the triangle of distances, at least ``_AROUND`` like the pivot and so linked to it.
    """
    links = done = None
    for _ in range(rounds):
        if large.isEmpty():
            break
        first = F.min(F.struct(F.xxhash64("rep").alias("hash"), "rep"))
        pivots = stored(large.groupBy("bucket").agg(first.alias("first")).select("bucket", F.col("first.rep").alias("pivot")), "pivots")
        paired = stored(large.join(pivots, "bucket").where("rep <> pivot").select("bucket", "rep", "pivot"), "paired")
        pairs = paired.select("rep", "pivot").distinct()
        pairs = pairs.join(sketch, "rep").join(sketch.select(F.col("rep").alias("pivot"), F.col("sketch").alias("other")), "pivot")
        alike = stored(pairs.select("rep", "pivot", "sketch", "other").mapInArrow(_estimated, "rep long, pivot long, alike double"), "alike")
        near = alike.where(F.col("alike") >= _AROUND).select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
        links = near if links is None else links.unionByName(near)
        left = paired.join(alike.where(F.col("alike") >= _CORE).select("rep", "pivot"), ["rep", "pivot"], "left_anti").select("bucket", "rep")
        sizes = left.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        left = stored(left.join(sizes, "bucket").select("bucket", "rep", "n"), "left")
        small = left.where(F.col("n") <= bucket)
        done = small if done is None else done.unionByName(small)
        large = left.where(F.col("n") > bucket)
    return links, large if links is None else done.unionByName(large)


def grouped(
    docs: DataFrame, size: int = 5, similarity: float = 0.8, recall: float = 0.9999, breadth: float = 1.25, depth: int = 2,
    bucket: int = 512, rounds: int = 3, block_rows: int = 1024, block_bytes: int = 8 << 20, nameless: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows, sets), stored: (doc_id, row, key1, key2, n_tokens, ...) of every row, and (key1, key2, copies, first_id, class, links) of every different set.

    ``class`` names the group of sets that hang together by links. Rows without a
    doc_id take part only if ``nameless``.
    """
    ready(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    described = stored(named.mapInArrow(
        _describe(size, similarity, breadth, depth, runs_needed(recall, breadth, depth)),
        "doc_id long, row long, key1 long, key2 long, n_tokens long, n_bytes long, sketch binary, paths array<bigint>"), "described")
    whole = described.where("n_tokens > 0") if nameless else described.where("n_tokens > 0 and doc_id is not null")
    # A set is known by a number of its own, not by a doc_id that other sets may share; one of its rows speaks for it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    sets = whole.groupBy("key1", "key2").agg(first, F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes"))
    sets = stored(sets.select(
        "key1", "key2", F.monotonically_increasing_id().alias("rep"), F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("row"), "copies", "n_bytes"), "sets")
    first = whole.join(sets.select("key1", "key2", "row", "rep"), ["key1", "key2", "row"])

    leaves = first.select("rep", F.explode(F.array_distinct("paths")).alias("bucket"))
    sizes = leaves.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(leaves.join(sizes, "bucket"), "members")
    sketch = stored(first.select("rep", "sketch").join(members.select("rep").distinct(), "rep", "left_semi"), "sketches")
    pivoted, left = _by_pivots(members.where(F.col("n") > bucket), sketch, bucket, rounds)
    rest = members.where(F.col("n") <= bucket).select("bucket", "rep", "n").unionByName(left.select("bucket", "rep", "n"))
    rest = _in_blocks(rest, F.ceil(F.col("n") / bucket).cast("long"), ["bucket"])
    bound = similarity - 5 * math.sqrt(similarity * (1 - similarity) / BINS)
    links = (
        rest.join(sketch, "rep").repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "rep")
        .select("bucket", "one", "two", "side", "rep", "sketch").mapInArrow(_compare_sketches(bound), "a long, b long"))
    clusters = stored(components(links if pivoted is None else links.unionByName(pivoted), "candidates"), "clusters")

    wanted = stored(clusters.select(F.col("node").alias("rep"), "component").join(sets, "rep"), "wanted")
    sizes = wanted.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    texts = with_keys(named, key_bits(wanted), size, only_marked=True).drop("marked")
    texts = texts.join(wanted.join(sizes, "component").hint("merge"), ["key1", "key2"]).where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    # Rows that agree in doc_id and set speak once.
    texts = texts.groupBy("key1", "key2", "rep", "component", "copies", "n", "bytes").agg(F.min("text").alias("text"))
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("bytes") / block_bytes)).cast("long")
    exact = (
        _in_blocks(texts, blocks, ["component", "copies", "text"])
        .repartition("component", "one", "two").sortWithinPartitions("component", "one", "two", "rep")
        .select("component", "one", "two", "side", "rep", "copies", "text").mapInArrow(_compare_sets(size, similarity), "a long, b long, links long"))
    exact = stored(exact, "links")
    classed = components(exact.select("a", "b"), "classes").select(F.col("node").alias("rep"), F.col("component").alias("class"))
    counted = exact.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = sets.join(classed, "rep", "left").join(counted, "rep", "left").select(
        "key1", "key2", "copies", "first_id", F.coalesce("class", "rep").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    return described, stored(known, "known-sets")


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, n_links) of every row: its near-duplicate class and how many other rows are similar to it.

    ``class_id`` is the smallest doc_id reached over links; a row without links is
    alone. Words are as in the benchmark contract; a text of fewer than ``size``
    words, but not none, is one run. Texts without words, NULL among them, are like
    nothing. Rows that share a doc_id are judged each by its own text. A NULL
    doc_id keeps a NULL class and no links. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows, sets = grouped(docs, **how)
    names = sets.groupBy("class").agg(F.min("first_id").alias("class_id"))
    known = sets.join(names, "class").select("key1", "key2", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return rows.select("doc_id", F.when(F.col("doc_id").isNotNull() & (F.col("n_tokens") > 0), F.col("key1")).alias("key1"), "key2").join(
        known, ["key1", "key2"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
