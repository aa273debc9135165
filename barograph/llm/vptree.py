"""Nearest neighbours by vantage-point trees, one per shard.

The largest inner product is made a smallest distance: vectors get one more
component so that all of a shard have its largest norm, queries get a zero
there, and the order stays. A node of a tree keeps a vantage point and, for
each of its two halves, the least and largest distance from that point. By the
triangle inequality a half whose distances are further from the query's than
its k-th best distance holds nothing nearer. That test is relaxed by a factor:
a half is left out once the gap exceeds best / factor, so that a larger factor
prunes more, and factor one restores exact search.

Equal vectors are one point with its smallest ids, so that a vector with most
of the rows costs as much as any other. A shard's tree is grown where a block of
queries meets it: that is little beside the block's search, and no tree is
written, sent or kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barograph.llm.tables import stored

#: Bytes of vectors in a shard at most, and the least number of shards.
SHARD_BYTES = 25_000_000
SHARDS = 8
#: Bytes of queries that meet a shard in one task: as many as of the shard's vectors, so that
#: neither side is sent more than the other. And queries that go through a tree together.
BLOCK_BYTES = SHARD_BYTES
AT_ONCE = 512
LEAF = 128
#: Scores this near are told apart by their exact values.
NEAR = 1e-9
#: Rounding of a distance, in shares of the shard's largest norm: roots of differences near zero.
ROUNDING = 1e-6
#: What a search gives: a query's point and digest, an id found for it, their score.
FOUND = pa.schema(
    {"point": pa.int64(), "print": pa.int64(), "found": pa.int64(), "score": pa.float64()}
)


@dataclass
class VantageTree:
    """Nodes as arrays; a leaf has no vantage point (-1) and spans ``begin`` to ``end``."""

    points: np.ndarray
    order: np.ndarray
    norm: float
    vantage: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    halves: np.ndarray  # of each node: its two children
    nearest: np.ndarray  # of each child: least and largest distance from its parent's point
    farthest: np.ndarray


def build_tree(points: np.ndarray, seed: int = 0) -> VantageTree:
    points = np.asarray(points, float)
    squares = (points * points).sum(axis=1)
    norm = float(squares.max(initial=0.0))
    lifted = np.hstack([points, np.sqrt(np.maximum(norm - squares, 0))[:, None]])
    random = np.random.default_rng(seed)
    order = np.arange(len(points))
    nodes: list[list] = []  # vantage, begin, end, children, nearest, farthest

    def grow(begin: int, end: int) -> int:
        at = len(nodes)
        nodes.append([-1, begin, end, [-1, -1], 0.0, np.inf])
        if end - begin <= LEAF:
            return at
        own = order[begin:end]
        vantage = own[random.integers(len(own))]
        away = np.sqrt(((lifted[own] - lifted[vantage]) ** 2).sum(axis=1))
        by = np.argsort(away, kind="stable")
        order[begin:end], away = own[by], away[by]
        half = len(own) // 2
        nodes[at][0] = vantage
        for side, (x, y) in enumerate(((0, half), (half, len(own)))):
            child = grow(begin + x, begin + y)
            nodes[at][3][side] = child
            nodes[child][4:] = [away[x], away[y - 1]]
        return at

    grow(0, len(points))
    vantage, begin, end, halves, nearest, farthest = zip(*nodes, strict=True)
    return VantageTree(
        points, order, norm, *map(np.array, (vantage, begin, end, halves, nearest, farthest))
    )


def search(
    tree: VantageTree,
    queries: np.ndarray,
    k: int,
    factor: float = 1.0,
    owner: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, score) of each query's k best points, and of points that tie with the k-th.

    All queries go through the tree together; at a node each first takes the
    half it lies in, and the other one with what it then knows. Where points
    have an ``owner``, those of one owner count once among the k, by the best.
    """
    points = tree.points
    own = (queries * queries).sum(axis=1)
    best = np.full((len(queries), k), -np.inf)  # of scores; the k-th in column 0
    held = np.zeros((len(queries), k), np.int64)  # their owners
    found: list[tuple[np.ndarray, ...]] = []

    def leaf(node: int, active: np.ndarray) -> None:
        which = tree.order[tree.begin[node] : tree.end[node]]
        scores = queries[active] @ points[which].T
        merged = np.concatenate([best[active], scores], axis=1)
        if owner is None:
            best[active] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            best[active] = np.sort(best[active], axis=1)
        else:
            shape = (len(active), len(which))
            owners = np.concatenate([held[active], np.broadcast_to(owner[which], shape)], axis=1)
            by = np.lexsort((-merged, owners))
            merged = np.take_along_axis(merged, by, axis=1)
            owners = np.take_along_axis(owners, by, axis=1)
            merged[:, 1:][owners[:, 1:] == owners[:, :-1]] = -np.inf
            by = np.argsort(merged, axis=1)[:, -k:]
            best[active] = np.take_along_axis(merged, by, axis=1)
            held[active] = np.take_along_axis(owners, by, axis=1)
        row, column = np.nonzero(scores >= best[active][:, :1] - NEAR)
        found.append((active[row], which[column], scores[row, column]))

    def may_hold(node: int, away: np.ndarray, active: np.ndarray) -> np.ndarray:
        gap = np.maximum(tree.nearest[node] - away, away - tree.farthest[node])
        reach = np.sqrt(np.maximum(own[active] + tree.norm - 2 * best[active, 0], 0))
        return gap <= reach / factor + ROUNDING * np.sqrt(tree.norm)

    def visit(node: int, active: np.ndarray) -> None:
        if not len(active):
            return
        vantage = tree.vantage[node]
        if vantage < 0:
            leaf(node, active)
            return
        gone = own[active] + tree.norm - 2 * (queries[active] @ points[vantage])
        away = np.sqrt(np.maximum(gone, 0))
        inner, outer = tree.halves[node]
        inside = away <= (tree.farthest[inner] + tree.nearest[outer]) / 2
        for first, second, side in ((inner, outer, inside), (outer, inner, ~inside)):
            here, distance = active[side], away[side]
            holds = may_hold(first, distance, here)
            visit(first, here[holds])
            holds = may_hold(second, distance, here)
            visit(second, here[holds])

    if len(points):
        visit(0, np.arange(len(queries)))
    if not found:
        none = np.zeros(0, int)
        return none, none, np.zeros(0)
    query, point, score = map(np.concatenate, zip(*found, strict=True))
    near = score >= best[query, 0] - NEAR
    query, point = query[near], point[near]
    # The exact measure, the same for equal vectors wherever they stand.
    exact = (queries[query] * points[point]).sum(axis=1)
    return query, point, exact


def usable(vector: Column) -> Column:
    """Vectors with a component other than zero and none that is null or not finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _top(query, ids, scores, k: int):
    """The k first ids of each query by best score, then id."""
    by = np.lexsort((-scores, ids, query))
    query, ids, scores = query[by], ids[by], scores[by]
    once = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])][: len(query)]
    query, ids, scores = query[once], ids[once], scores[once]
    by = np.lexsort((ids, -scores, query))
    query, ids, scores = query[by], ids[by], scores[by]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    keep = rank < k
    return query[keep], ids[keep], scores[keep]


def nearest(
    vectors: DataFrame,
    every: int,
    k: int = 20,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per query its ``k`` nearest: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    but those with the query's id. Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do null ids. Vectors of another
    length are no candidates of a query. Equal rows count once. An id with
    several vectors is, as a query, searched for with each, and as a candidate
    listed once; the score is the best of any two vectors of both ids. Other
    columns are not looked at. An empty table gives no rows.
    """
    own = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
    )
    own = own.filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).distinct()
    # One id more than asked for, as the query's own may be among them.
    wanted = k + 1
    smallest = Window.partitionBy("v").orderBy("vec_id")
    points = (
        own.withColumn("nth", F.row_number().over(smallest))
        .filter(F.col("nth") <= wanted)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("size", F.size("v"))
    )
    points = stored(points, "points")
    # Aggregated before the shuffle and joined back, so that a vector with most of the queries
    # is a hot side of a join, which adaptive execution splits.
    asked = own.filter(F.col("vec_id") % every == 0).withColumn("print", F.xxhash64("v"))
    first_ids = asked.groupBy("print", "v").agg(F.min("vec_id").alias("point"))
    asked = stored(asked.join(first_ids, ["print", "v"]), "asked")
    distinct = asked.filter(F.col("vec_id") == F.col("point")).select(
        "point", "print", "v", F.size("v").alias("size")
    )
    many = {row["size"]: row["n"] for row in _sizes(points)}
    # Shards and blocks of each vector length; lengths are few, the table is small.
    plan = {n: max(SHARDS, -(-many[n] // max(1, SHARD_BYTES // (8 * n)))) for n in many}
    asked_of = {row["size"]: row["n"] for row in _sizes(distinct)}
    blocks = {n: -(-asked_of[n] // max(1, BLOCK_BYTES // (8 * n))) for n in asked_of}

    def of(values: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("size"))

    def each(values: dict[int, int]) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), of(values).cast("long") - 1))

    if not blocks:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    digest = F.xxhash64("v").alias("print")
    held = points.filter(F.col("size").isin(list(blocks))).select(
        "size", F.pmod(digest, of(plan)).alias("shard"), each(blocks).alias("block"), "v", "ids", digest
    )
    sought = distinct.select(
        "size",
        each(plan).alias("shard"),
        F.pmod(F.xxhash64("print"), of(blocks)).alias("block"),
        *["v", "point", "print"],
    )

    def seek(held: pa.Table, sought: pa.Table) -> pa.Table:
        if not len(held) or not len(sought):
            return FOUND.empty_table()
        # Any order of rows gives the same tree.
        members = _whole(held["ids"])
        smallest_ids = _whole(pc.list_element(members, 0)).to_numpy()
        by = np.lexsort((held["print"].to_numpy(), smallest_ids))
        members, smallest_ids = members.take(pa.array(by)), smallest_ids[by]
        tree = build_tree(_matrix(held["v"])[by])
        flat, counts = members.flatten().to_numpy(), members.value_lengths().to_numpy()
        starts = np.cumsum(counts) - counts
        repeated = len(np.unique(smallest_ids)) < len(members)
        asked_ids = [sought[x].to_numpy() for x in ("point", "print")]
        queries, parts = _matrix(sought["v"]), []
        for at in range(0, len(queries), AT_ONCE):
            query, point, score = search(
                tree, queries[at : at + AT_ONCE], wanted, factor, smallest_ids if repeated else None
            )
            wide = counts[point]
            step = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
            found = flat[np.repeat(starts[point], wide) + step]
            query, found, score = _top(np.repeat(query, wide), found, np.repeat(score, wide), wanted)
            own = [x[at + query] for x in asked_ids]
            parts.append(pa.RecordBatch.from_arrays([*map(pa.array, (*own, found, score))], schema=FOUND))
        return pa.Table.from_batches(parts, FOUND)

    # Each pair of a shard and a block is one group: a task holds one of each at a time.
    met = ["size", "shard", "block"]
    found = held.groupBy(*met).cogroup(sought.groupBy(*met)).applyInArrow(
        seek, "point long, print long, found long, score double"
    )
    # The smallest id may be that of several vectors; with its digest each is told apart.
    own_vector = ["point", "print"]
    found = found.repartition(*own_vector).groupBy(*own_vector, "found").agg(
        F.max("score").alias("score")
    )
    first = Window.partitionBy(*own_vector).orderBy(F.desc("score"), "found")
    best = found.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= wanted)
    queries = asked.select(F.col("vec_id").alias("query_id"), *own_vector)
    hits = queries.join(best.select(*own_vector, "found", "score"), own_vector)
    hits = hits.filter(F.col("found") != F.col("query_id"))
    hits = hits.repartition("query_id").groupBy("query_id", "found").agg(
        F.max("score").alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found").alias("vec_id"), "score")
    )


def _whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A column as one array."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return _whole(vectors).flatten().to_numpy().reshape(len(vectors), -1)


def _sizes(rows: DataFrame) -> list:
    return rows.groupBy("size").agg(F.count("*").alias("n")).collect()
