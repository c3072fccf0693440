"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Equal vectors are one node. Nodes stand in blocks, by their nearest pivot; nodes
that meet around one of their nearest pivots begin with the closest of
each other as neighbours. Every round then joins, around each node, the
neighbours it has and those that have it: whoever of two is among the other's best
becomes its neighbour. Vectors come to a block once, however many of its nodes
name them. Queries start at nodes of their own cells and at sampled ones, and walk the graph: each step sends a query to the
blocks of the nodes it has heard of, goes on there greedily, and
brings back what it has measured and which nodes of other blocks come next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready, stored
from retailloom.llm.topk import usable

#: A node's number is its block's and its place there; a block's number is its cell's and its chunk's.
PLACE_BITS = 20
_GRAPH = "node long, block long, vec array<float>, nbrs array<long>, dists array<float>, fresh array<boolean>"
_FOUND = "block long, node long, nbrs array<long>, dists array<float>"
_STATE = "query long, vec array<float>, beam array<long>, dists array<float>, done array<boolean>, seen array<long>, blocks array<long>, nodes array<array<long>>"
_HEARD = "query long, nbrs array<long>, dists array<float>, done array<boolean>, ahead array<long>"


def _block(node: str) -> Column:
    return F.shiftright(node, PLACE_BITS)


# --- arrays inside tasks ------------------------------------------------------------------


def _lists(table: pa.Table | pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the length of each list."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _matrix(table: pa.Table | pa.RecordBatch, name: str = "vec") -> np.ndarray:
    values, sizes = _lists(table, name)
    return values.reshape(len(sizes), -1).astype(np.float32) if len(sizes) else np.zeros((0, 0), np.float32)


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values).cast(kind))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, taken from a common point near both."""
    middle = a[:1]
    a, b = a - middle, b - middle
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def _nearest(owner: np.ndarray, other: np.ndarray, dist: np.ndarray, k: int, stale: np.ndarray | None = None) -> np.ndarray:
    """Indices of each owner's ``k`` nearest others, each once, in order; of equal pairs the stale one stays."""
    stale = np.zeros(len(owner), bool) if stale is None else stale
    order = np.lexsort((~stale, other, owner))
    once = np.ones(len(order), bool)
    once[1:] = (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1])
    order = order[once]
    order = order[np.lexsort((other[order], dist[order], owner[order]))]
    own = owner[order]
    begin = np.searchsorted(own, own, "left")
    return order[np.arange(len(order)) - begin < k]


def _found(owner: np.ndarray, other: np.ndarray, dist: np.ndarray, k: int) -> pa.Table:
    best = _nearest(owner, other, dist, k)
    node, sizes = np.unique(owner[best], return_counts=True)
    return pa.table([pa.array(node >> PLACE_BITS), pa.array(node), _list_array(other[best], sizes, pa.list_(pa.int64()).value_type),
                     _list_array(dist[best], sizes, pa.float32())], ["block", "node", "nbrs", "dists"])


def _both(left: DataFrame, right: DataFrame, by: str, mark: str, run, schema: str) -> DataFrame:
    """``run`` over the rows of both tables, group by group; ``mark`` is a column that ``right`` lacks and ``left`` always has.

    The tables are shuffled and sorted as one, which takes half the exchanges of a cogroup.
    """

    def split(rows: pa.Table) -> pa.Table:
        own = pc.is_valid(rows.column(mark))
        return run(rows.filter(own), rows.filter(pc.invert(own)))

    return left.unionByName(right, allowMissingColumns=True).groupBy(by).applyInArrow(split, schema)


# --- nodes and first lists ----------------------------------------------------------------


def _cells(sent, width: int):
    """Adds the cells of a vector's ``width`` nearest pivots; without a pivot of its length, the cell of that length."""

    def run(batches: Iterator[pa.RecordBatch]):
        pivots: dict[int, tuple[np.ndarray, np.ndarray]] = sent.value
        for batch in batches:
            values, sizes = _lists(batch, "embedding")
            ends = np.cumsum(sizes)
            cells: list[list[int]] = [[]] * batch.num_rows
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                if size not in pivots:
                    for r in rows.tolist():
                        cells[r] = [(1 << 16) + size]
                    continue
                names, points = pivots[size]
                vec = values[(ends[rows] - size)[:, None] + np.arange(size)].astype(np.float32)
                near = np.argsort(_squares(vec, points), axis=1, kind="stable")[:, :width]
                for r, row in zip(rows.tolist(), names[near].tolist(), strict=True):
                    cells[r] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], [*batch.schema.names, "cells"])

    return run


def _placed(block: pa.Table) -> pa.Table:
    number = _ints(block, "block")
    return block.append_column("node", pa.array((number << PLACE_BITS) + np.arange(len(number))))


def _met(k: int):
    """The first lists: all nodes of one chunk compared."""

    def run(chunk: pa.Table) -> pa.Table:
        node, vec = _ints(chunk, "node"), _matrix(chunk)
        owner, other, dist = [], [], []
        # A few more than asked, as products blur small distances; those of the chosen are then taken from differences.
        width = min(2 * k, len(node))
        for first in range(0, len(node), 512):
            near = np.argpartition(_squares(vec[first : first + 512], vec), width - 1, axis=1)[:, :width]
            owner.append(np.repeat(node[first : first + 512], width))
            other.append(node[near].ravel())
            dist.append(_gaps(np.repeat(vec[first : first + 512], width, axis=0), vec[near.ravel()]))
        owner, other, dist = (np.concatenate(x) for x in (owner, other, dist))
        apart = owner != other
        return _found(owner[apart], other[apart], dist[apart], k)

    return run


def _updated(k: int):
    """Lists of a block's nodes after what a round found; what is new counts as fresh."""

    def run(graph: pa.Table, found: pa.Table) -> pa.Table:
        node = _ints(graph, "node")
        old, old_sizes = _lists(graph, "nbrs")
        new, new_sizes = _lists(found, "nbrs")
        owner = np.concatenate([np.repeat(node, old_sizes), np.repeat(_ints(found, "node"), new_sizes)])
        other = np.concatenate([old, new]).astype(np.int64)
        dist = np.concatenate([_lists(graph, "dists")[0], _lists(found, "dists")[0]]).astype(np.float32)
        stale = np.arange(len(owner)) < len(old)
        best = _nearest(owner, other, dist, k, stale)
        # Back into the order of the block's rows.
        row = np.argsort(node)[np.searchsorted(np.sort(node), owner[best])]
        best = best[np.argsort(row, kind="stable")]
        sizes = np.bincount(row, minlength=len(node))
        lists = [_list_array(other[best], sizes, pa.int64()), _list_array(dist[best], sizes, pa.float32()), _list_array(~stale[best], sizes, pa.bool_())]
        return pa.table([graph.column("node"), graph.column("block"), graph.column("vec"), *lists], ["node", "block", "vec", "nbrs", "dists", "fresh"])

    return run


def _around(k: int, slots: int = 2_000_000):
    """The join around each node of a block: pairs of its neighbours, one of them fresh, that are among each other's best."""

    def run(edges: pa.Table, vectors: pa.Table) -> pa.Table:
        ids = _ints(vectors, "other")
        order = np.argsort(ids)
        ids, vec, bound = ids[order], _matrix(vectors)[order], vectors.column("bound").to_numpy().astype(np.float32)[order]
        centre, fresh = _ints(edges, "centre"), edges.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
        at = np.searchsorted(ids, _ints(edges, "other"))
        order = np.lexsort((~fresh, at, centre))
        centre, at, fresh = centre[order], at[order], fresh[order]
        once = np.ones(len(order), bool)
        once[1:] = (centre[1:] != centre[:-1]) | (at[1:] != at[:-1])
        centre, at, fresh = centre[once], at[once], fresh[once]
        _, begin, sizes = np.unique(centre, return_index=True, return_counts=True)
        some = np.logical_or.reduceat(fresh, begin) if len(begin) else np.zeros(0, bool)
        begin, sizes = begin[some & (sizes > 1)], sizes[some & (sizes > 1)]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def packed() -> None:
            owner, other, dist = (np.concatenate(x) for x in zip(*held, strict=True))
            best = _nearest(owner, other, dist, k)
            held[:] = [(owner[best], other[best], dist[best])]

        wide = int(sizes.max(initial=0))
        upper = np.triu(np.ones((wide, wide), bool), 1)
        for first in range(0, len(begin), 64):
            b, s = begin[first : first + 64], sizes[first : first + 64]
            slot = np.arange(wide)
            there = slot < s[:, None]
            place = np.where(there, b[:, None] + slot, b[:, None])
            who, new = at[place], fresh[place] & there
            points = vec[who] - vec[who[:, :1]]
            length = np.einsum("nij,nij->ni", points, points)
            d = np.maximum(length[:, :, None] + length[:, None, :] - 2 * (points @ points.transpose(0, 2, 1)), 0)
            pair = upper & there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :])
            blur = 1e-5 * (length[:, :, None] + length[:, None, :])
            pair &= (d - blur < bound[who][:, :, None]) | (d - blur < bound[who][:, None, :])
            n, i, j = np.nonzero(pair)
            one, two = who[n, i], who[n, j]
            dist = _gaps(vec[one], vec[two])
            for x, y in ((one, two), (two, one)):
                near = dist < bound[x]
                held.append((x[near], y[near], dist[near]))
            if sum(len(h[0]) for h in held) > slots:
                packed()
        if not held:
            held.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)))
        packed()
        owner, other, dist = held[0]
        return _found(ids[owner], ids[other], dist, k)

    return run


def _edges(graph: DataFrame, reverse: int) -> DataFrame:
    """(centre, other, fresh): each node's neighbours, and at most ``reverse`` of those that have it, by hash."""
    own = graph.select(F.col("node").alias("centre"), F.explode(F.arrays_zip("nbrs", "fresh")).alias("e")).select("centre", F.col("e.nbrs").alias("other"), F.col("e.fresh").alias("fresh"))
    back = own.select(F.col("other").alias("centre"), F.col("centre").alias("other"), "fresh")
    chosen = Window.partitionBy("centre").orderBy(F.xxhash64("centre", "other"), "other")
    back = back.withColumn("nth", F.row_number().over(chosen)).where(F.col("nth") <= reverse).drop("nth")
    return own.unionByName(back)


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(embedding, members): every different usable vector that is not zero, with its ``keep`` smallest vec_ids."""
    rows = usable(vectors).where(F.exists("embedding", lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    first = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("nth", F.dense_rank().over(first)).where(F.col("nth") <= keep)
    return few.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("members"))


@dataclass(frozen=True)
class Index:
    """``nodes``: node, embedding, members. ``graph``: node, block, vec and the neighbours with squared distances.
    ``homes``: the cells and how many blocks each has. ``pivots``: by vector length, the cells and their points."""

    nodes: DataFrame
    graph: DataFrame
    homes: DataFrame
    pivots: dict[int, tuple[np.ndarray, np.ndarray]]
    meetings: int


def build(vectors: DataFrame, keep: int = 11, k: int = 24, reverse: int = 24, rounds: int = 4, block_rows: int = 2048, meetings: int = 3, pivots: int = 512) -> Index:
    """The graph of ``k`` neighbours over all usable vectors, stored.

    At most ``pivots`` vectors are sampled by hash as pivots; a crowded cell is cut into
    chunks of about ``block_rows`` by hash, so no group grows with the table.
    """
    spark = ready(vectors.sparkSession)
    reps = stored(classes(vectors, keep), "vector-classes")
    count = reps.count()
    sample = reps.orderBy(F.xxhash64("embedding")).select("embedding").limit(min(pivots, -(-2 * count // block_rows))).toArrow()
    by_size: dict[int, list[tuple[int, list[float]]]] = {}
    for name, v in enumerate(sample["embedding"].to_pylist()):
        by_size.setdefault(len(v), []).append((name, v))
    points = {s: (np.array([n for n, _ in own], np.int64), np.array([v for _, v in own], np.float32)) for s, own in by_size.items()}
    sent = spark.sparkContext.broadcast(points)
    kind = reps.schema["embedding"].dataType.simpleString()
    given = stored(reps.mapInArrow(_cells(sent, meetings), f"embedding {kind}, members array<long>, cells array<long>"), "vector-cells")
    crowds = given.select(F.posexplode("cells").alias("turn", "cell")).groupBy("turn", "cell").agg(F.ceil(F.count("*") / block_rows).alias("chunks"))
    crowds = stored(crowds, "cells")
    homes = crowds.where("turn = 0").select(F.col("cell"), "chunks")
    chunk = F.pmod(F.xxhash64("embedding"), F.col("chunks"))
    homed = given.withColumn("cell", F.element_at("cells", 1)).join(homes, "cell").withColumn("block", F.shiftleft("cell", PLACE_BITS) + chunk)
    nodes = stored(homed.select("block", "embedding", "members", "cells").groupBy("block").applyInArrow(
        _placed, f"block long, embedding {kind}, members array<long>, cells array<long>, node long"), "nodes")
    vec = F.col("embedding").cast("array<float>").alias("vec")
    meets = nodes.select("node", vec, F.posexplode("cells").alias("turn", "cell")).join(crowds, ["turn", "cell"])
    meets = meets.withColumn("chunk", F.pmod(F.xxhash64("node", "turn"), F.col("chunks"))).select("turn", "cell", "chunk", "node", "vec")
    found = meets.groupBy("turn", "cell", "chunk").applyInArrow(_met(k), _FOUND)
    none = [F.array().cast(t).alias(n) for n, t in (("nbrs", "array<long>"), ("dists", "array<float>"), ("fresh", "array<boolean>"))]
    graph = nodes.select("node", "block", vec, *none)

    def merged(graph: DataFrame, found: DataFrame) -> DataFrame:
        return stored(_both(graph, found, "block", "vec", _updated(k), _GRAPH), "graph")

    graph = merged(graph, found)
    for _ in range(rounds):
        edges = _edges(graph, reverse).withColumn("block", _block("centre"))
        bound = F.when(F.size("dists") < k, F.lit(float("inf"))).otherwise(F.element_at("dists", -1)).cast("float").alias("bound")
        needed = edges.select("block", "other").distinct().join(graph.select(F.col("node").alias("other"), "vec", bound), "other").select("block", "other", "vec", "bound")
        found = _both(edges, needed, "block", "centre", _around(k), _FOUND)
        graph = merged(graph, found)
    return Index(nodes.select("node", "embedding", "members"), graph, homes, points, meetings)


# --- search -------------------------------------------------------------------------------


def _dealt(nodes: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Of each row's nodes: the blocks they stand in, and those of each block."""
    ordered = [np.sort(n) for n in nodes]
    flat = np.concatenate([np.zeros(0, np.int64), *ordered])
    row = np.repeat(np.arange(len(nodes)), [len(n) for n in nodes])
    block = flat >> PLACE_BITS
    new = np.ones(len(flat), bool)
    new[1:] = (block[1:] != block[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    per_row = np.bincount(row[begin], minlength=len(nodes))
    inner = _list_array(flat, np.diff(np.append(begin, len(flat))), pa.int64())
    ends = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
    return _list_array(block[begin], per_row, pa.int64()), pa.ListArray.from_arrays(ends, inner)


def _started(sent, width: int, first: int):
    """Every query's best of the sampled nodes; the walk begins at the ``first`` of them, the others only bound it."""

    def run(batches: Iterator[pa.RecordBatch]):
        starts: dict[int, tuple[np.ndarray, np.ndarray]] = sent.value
        for batch in batches:
            values, sizes = _lists(batch, "vec")
            ends = np.cumsum(sizes)
            beam: list[list[int]] = [[]] * batch.num_rows
            dists: list[list[float]] = [[]] * batch.num_rows
            for size in np.unique(sizes).tolist():
                if size not in starts:
                    continue
                rows = np.flatnonzero(sizes == size)
                names, points = starts[size]
                vec = values[(ends[rows] - size)[:, None] + np.arange(size)].astype(np.float32)
                d = _squares(vec, points)
                near = np.argsort(d, axis=1, kind="stable")[:, :width]
                for r, ids, ds in zip(rows.tolist(), names[near].tolist(), np.take_along_axis(d, near, 1).tolist(), strict=True):
                    beam[r], dists[r] = ids, ds
            done = [[place >= first for place in range(len(b))] for b in beam]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vec"), pa.array(beam, longs), pa.array(dists, pa.list_(pa.float32())), pa.array(done, pa.list_(pa.bool_())),
                 pa.array(beam, longs), *_dealt([np.array(b[:first], np.int64) for b in beam])], ["query", "vec", "beam", "dists", "done", "seen", "blocks", "nodes"])

    return run


def _walked(beam: int, rounds: int, at_once: int):
    """Greedy steps of many queries within one block."""

    def run(asked: pa.Table, graph: pa.Table) -> pa.Table:
        node = _ints(graph, "node")
        order = np.argsort(node)
        vec = _matrix(graph)
        flat, sizes = _lists(graph, "nbrs")
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sorted_node, out = node[order], {n: [] for n in ("query", "nbrs", "dists", "done", "ahead")}
        given, given_sizes = _lists(asked, "nodes")
        given_ends = np.cumsum(given_sizes)
        queries, points, bounds = asked.column("query").to_numpy(), _matrix(asked), asked.column("bound").to_numpy()
        for i in range(len(queries)):
            if given_sizes[i]:
                place = np.searchsorted(sorted_node, given[given_ends[i] - given_sizes[i] : given_ends[i]])
                now = np.unique(order[place])
            else:  # the block of one of the query's own cells: it begins at the nearest nodes there
                now = np.argsort(_gaps(vec, points[i]), kind="stable")[:at_once]
            # Distances of start nodes were summed in another order.
            bound = float(bounds[i]) * (1 + 1e-5)
            seen = np.zeros(len(node), bool)
            dist = np.full(len(node), np.inf, np.float32)
            done = np.zeros(len(node), bool)
            ahead = [np.zeros(0, np.int64)]
            for _ in range(rounds):
                if len(now):
                    seen[now] = True
                    dist[now] = _gaps(vec[now], points[i])
                open_ = np.flatnonzero(seen & ~done & (dist <= bound))
                if not len(open_):
                    break
                open_ = open_[np.argsort(dist[open_], kind="stable")[:at_once]]
                done[open_] = True
                near = np.unique(np.concatenate([flat[ends[o] : ends[o + 1]] for o in open_.tolist()]))
                at = np.minimum(np.searchsorted(sorted_node, near), len(node) - 1)
                here = sorted_node[at] == near
                ahead.append(near[~here])
                now = order[at[here]]
                now = now[~seen[now]]
                if seen.sum() >= beam:
                    bound = min(bound, float(np.partition(dist[seen], beam - 1)[beam - 1]))
            else:
                if len(now):
                    seen[now] = True
                    dist[now] = _gaps(vec[now], points[i])
            # All that was met is told, so that it is not walked to again.
            met = np.flatnonzero(seen)
            out["query"].append(queries[i])
            out["nbrs"].append(node[met])
            out["dists"].append(dist[met])
            out["done"].append(done[met])
            out["ahead"].append(np.unique(np.concatenate(ahead)))
        return _heard(out)

    return run


def _heard(out: dict[str, list]) -> pa.Table:
    kinds = {"nbrs": pa.int64(), "dists": pa.float32(), "done": pa.bool_(), "ahead": pa.int64()}
    columns = [pa.array(np.array(out["query"], np.int64))]
    for name, kind in kinds.items():
        values = np.concatenate(out[name]) if out[name] else np.zeros(0, kind.to_pandas_dtype())
        columns.append(_list_array(values, np.array([len(x) for x in out[name]], np.int64), kind))
    return pa.table(columns, ["query", *kinds])


def _gathered(beam: int):
    """A query's beam after a step: the best of all it has met, and where it has not been yet."""

    def run(state: pa.Table, heard: pa.Table) -> pa.Table:
        column = lambda name: _lists(state, name)[0]
        ids = np.concatenate([column("beam"), _lists(heard, "nbrs")[0]]).astype(np.int64)
        dist = np.concatenate([column("dists"), _lists(heard, "dists")[0]]).astype(np.float32)
        done = np.concatenate([column("done"), _lists(heard, "done")[0]]).astype(bool)
        order = np.lexsort((~done, ids))
        once = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])] if len(order) else order
        seen = np.union1d(column("seen"), ids).astype(np.int64)
        best = once[np.lexsort((ids[once], dist[once]))][:beam]
        ahead = np.setdiff1d(_lists(heard, "ahead")[0], seen).astype(np.int64)
        going = np.concatenate([ids[best][~done[best]], ahead])
        one = lambda v, kind: _list_array(v, np.array([len(v)]), kind)
        return pa.table([state.column("query"), state.column("vec"), one(ids[best], pa.int64()), one(dist[best], pa.float32()), one(done[best], pa.bool_()),
                         one(seen, pa.int64()), *_dealt([going])], ["query", "vec", "beam", "dists", "done", "seen", "blocks", "nodes"])

    return run


def _home_blocks(asked: DataFrame, index: Index) -> DataFrame:
    """(query, block): one block of each of a query's cells."""
    sent = asked.sparkSession.sparkContext.broadcast(index.pivots)
    kind = asked.schema["embedding"].dataType.simpleString()
    cells = asked.select("query", "embedding").mapInArrow(_cells(sent, index.meetings), f"query long, embedding {kind}, cells array<long>")
    cells = cells.select("query", F.explode("cells").alias("cell")).join(index.homes, "cell")
    return cells.select("query", (F.shiftleft("cell", PLACE_BITS) + F.pmod(F.xxhash64("query"), F.col("chunks"))).alias("block"))


def search(queries: DataFrame, index: Index, k: int = 10, beam: int = 160, starts: int = 1024, steps: int = 48, reverse: int = 24) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found in the graph of ``build``, nearest first, ties to the smaller vec_id.

    A query begins at the nearest of ``starts`` sampled nodes and of one block of each of its own cells, as
    groups that no other node points to are reached from there only. Scores are distances of the given vectors in double precision. A step ends
    when no query has a node left to go to that could enter its ``beam``. A query meets vectors of its length only and
    never its own id; a repeated query counts once, with its smallest vector.
    """
    spark = ready(queries.sparkSession)
    asked = usable(queries).where(F.exists("embedding", lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("query"), "embedding")
    asked = stored(asked.groupBy("query").agg(F.min("embedding").alias("embedding")), "queries")
    graph, nodes = index.graph, index.nodes
    links = _edges(graph, reverse).groupBy("centre").agg(F.collect_set("other").alias("nbrs"))
    walk = graph.select("node", "block", "vec").join(links.withColumnRenamed("centre", "node"), "node", "left")
    walk = stored(walk.select("node", "block", "vec", F.coalesce("nbrs", F.array().cast("array<long>")).alias("nbrs")), "walk")
    sample = walk.orderBy(F.xxhash64("node")).select("node", "vec").limit(starts).toArrow()
    by_size: dict[int, list[tuple[int, list[float]]]] = {}
    for node, vec in zip(sample["node"].to_pylist(), sample["vec"].to_pylist(), strict=True):
        by_size.setdefault(len(vec), []).append((node, vec))
    sent = spark.sparkContext.broadcast({s: (np.array([n for n, _ in own], np.int64), np.array([v for _, v in own], np.float32)) for s, own in by_size.items()})
    state = stored(asked.select("query", F.col("embedding").cast("array<float>").alias("vec")).mapInArrow(_started(sent, beam, 32), _STATE), "walks")
    for step in range(steps):
        bound = F.when(F.size("beam") < beam, F.lit(float("inf"))).otherwise(F.element_at("dists", -1)).cast("float").alias("bound")
        if step:
            going = state.select("query", "vec", bound, F.explode(F.arrays_zip("blocks", "nodes")).alias("to"))
            going = going.select(F.col("to.blocks").alias("block"), "query", "vec", "bound", F.col("to.nodes").alias("nodes"))
        else:
            going = state.select("query", "vec", bound).join(_home_blocks(asked, index), "query").select("block", "query", "vec", "bound", F.array().cast("array<long>").alias("nodes"))
        if step and going.isEmpty():
            break
        told = _both(going, walk, "block", "query", _walked(beam, 2, 8), _HEARD)
        state = stored(_both(state.drop("blocks", "nodes"), told, "query", "vec", _gathered(beam), _STATE), "walks")
    # Twice the asked number, as the walk's distances are single precision.
    best = state.select("query", F.explode(F.slice("beam", 1, 2 * k + 2)).alias("node")).join(nodes, "node").select("query", F.col("embedding").alias("near"), "members")
    gap = F.zip_with(F.col("embedding").cast("array<double>"), F.col("near").cast("array<double>"), lambda x, y: (x - y) * (x - y))
    score = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))
    rows = best.join(asked, "query").select(F.col("query").alias("query_id"), score.alias("score"), F.explode("members").alias("vec_id")).where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, **how: int) -> DataFrame:
    """``build`` over ``vectors``, ``search`` for ``queries``.

    Vectors that are NULL, empty or zero or hold a NULL or non-finite component
    take no part. Rows that repeat an id and its vector count once; an id with several vectors is a candidate with
    each. Extra columns play no part. Empty tables give no rows.
    """
    return search(queries, build(vectors, keep=k + 1, **how), k)
