"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched with a beam."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import parts, require
from corvane.session import cut

#: Distinct vectors of a shard, about; queries that meet a shard's graph in one task at most.
SHARD_ROWS, BLOCK_QUERIES = 4096, 16384
#: Edges of a node, candidates kept while building and while searching, and the pruning's relaxation.
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 96, 1.2
#: Nodes that one round of a search expands for each query, and queries searched side by side.
EXPAND, SIDE = 4, 256


def _squares(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of q[b] to x[ids[b, j]]; ids below 0 are infinitely far."""
    gap = x[np.maximum(ids, 0)] - q[:, None, :]
    out = np.einsum("bjd,bjd->bj", gap, gap)
    out[ids < 0] = np.inf
    return out


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `beam` nearest nodes met, nearest first (-1: none), with squared distances.

    Best first from `entry`: the nearest nodes not yet expanded give their neighbours, until the whole
    beam is expanded.
    """
    n, m = len(q), len(x)
    ids, far = np.full((n, beam), -1, np.int32), np.full((n, beam), np.inf, np.float32)
    seen, spent = np.zeros((n, m + 1), bool), np.zeros((n, beam), bool)
    ids[:, 0], seen[:, entry] = entry, True
    far[:, 0] = _squares(x, ids[:, :1], q)[:, 0]
    live = np.arange(n)
    while len(live):
        waiting = ~spent[live] & (ids[live] >= 0)
        place = np.argsort(~waiting, axis=1, kind="stable")[:, :EXPAND]
        real = np.take_along_axis(waiting, place, 1)
        live, place, real = live[real[:, 0]], place[real[:, 0]], real[real[:, 0]]
        if not len(live):
            break
        rows = live[:, None]
        nodes = np.where(real, ids[rows, place], -1)
        spent[rows, place] |= real
        new = np.where((nodes >= 0)[:, :, None], graph[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[rows, new]] = -1
        seen[rows, new] = True
        seen[:, m] = False  # the place that -1 marks
        both = np.concatenate([far[live], _squares(x, new, q[live])], axis=1)
        order = np.argsort(both, axis=1, kind="stable")[:, :beam]
        far[live] = np.take_along_axis(both, order, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), order, 1)
        spent[live] = np.take_along_axis(np.concatenate([spent[live], np.zeros(new.shape, bool)], axis=1), order, 1)
        ids[live] = np.where(np.isinf(far[live]), -1, ids[live])
    return ids, far


def robust_prune(x: np.ndarray, ids: np.ndarray, far: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to `degree` diverse edges from candidates sorted by distance (-1: none).

    The nearest candidate left is kept and drops each candidate that it is closer to, by the factor alpha,
    than the node itself is.
    """
    points = x[np.maximum(ids, 0)]
    norms = np.einsum("bjd,bjd->bj", points, points)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
    open_, kept = ids >= 0, np.full((len(ids), degree), -1, np.int32)
    rows = np.arange(len(ids))
    for k in range(degree):
        first = open_.argmax(axis=1)
        some = open_[rows, first]
        if not some.any():
            break
        kept[some, k] = ids[rows, first][some]
        open_ &= alpha * alpha * between[rows, first] > far
        open_[rows, first] = False
    return kept


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, int]:
    """Edges (node by degree + 1, -1: none) and the entry node.

    Nodes join in a seeded order, in batches that double: a greedy search over the nodes before proposes
    candidates, pruning picks edges, and each edge is offered back to its end, pruned again where that has
    too many. The last column is a cycle through all nodes, so every node can be reached.
    """
    n = len(x)
    order = np.random.default_rng(seed).permutation(n)
    graph = np.full((n, degree + 1), -1, np.int32)
    entry = int(_squares(x, np.arange(n)[None, :], x.mean(axis=0)[None, :])[0].argmin()) if n else 0
    order = np.concatenate([[entry], order[order != entry]]).astype(np.int64)
    done = 1
    while done < n:
        batch = order[done : done + min(max(done, 16), 512)]
        found, gaps = [], []
        for at in range(0, len(batch), SIDE):
            i, f = beam_search(x, graph, entry, x[batch[at : at + SIDE]], beam)
            found.append(i)
            gaps.append(f)
        graph[batch, :degree] = robust_prune(x, np.concatenate(found), np.concatenate(gaps), degree, alpha)
        ends = graph[batch, :degree]
        source = np.repeat(batch, degree)[ends.ravel() >= 0]
        target = ends.ravel()[ends.ravel() >= 0]
        touched = np.unique(target)
        old = graph[touched, :degree]
        target = np.concatenate([target, np.repeat(touched, degree)[old.ravel() >= 0]])
        source = np.concatenate([source, old.ravel()[old.ravel() >= 0]])
        gap = x[target] - x[source]
        gap = np.einsum("ij,ij->i", gap, gap)
        by = np.lexsort((source, gap, target))
        target, source, gap = target[by], source[by], gap[by]
        start = np.searchsorted(target, touched)
        place = np.arange(len(target)) - np.repeat(start, np.diff(np.append(start, len(target))))
        row = np.searchsorted(touched, target)
        width = 3 * degree
        ids, far = np.full((len(touched), width), -1, np.int32), np.full((len(touched), width), np.inf, np.float32)
        near = place < width
        ids[row[near], place[near]], far[row[near], place[near]] = source[near], gap[near]
        many = ids[:, degree] >= 0
        graph[touched[~many], :degree] = ids[~many, :degree]
        for at in range(0, int(many.sum()), SIDE):
            part = np.flatnonzero(many)[at : at + SIDE]
            graph[touched[part], :degree] = robust_prune(x, ids[part], far[part], degree, alpha)
        done += len(batch)
    graph[order, degree] = np.roll(order, -1)
    return graph, entry


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float32).reshape(len(column), -1)


def _build(table: pa.Table) -> pa.Table:
    graph, entry = build_graph(_matrix(table.column("embedding")))
    edges = pa.array([row.tobytes() for row in graph], pa.binary())
    place = pa.array(np.arange(len(graph), dtype=np.int64))
    return table.append_column("place", place).append_column("edges", edges).append_column("entry", pa.array(np.full(len(graph), entry, np.int64)))


def _search(k: int, beam: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if shard.num_rows and queries.num_rows:
            shard = shard.sort_by("place")
            x = _matrix(shard.column("embedding"))
            graph = np.frombuffer(b"".join(shard.column("edges").to_pylist()), np.int32).reshape(len(x), -1)
            members, entry = shard.column("ids").to_pylist(), shard.column("entry")[0].as_py()
            exact = shard.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1)
            names = queries.column("query_id").to_pylist()
            q = queries.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(names), -1)
            for at in range(0, len(names), SIDE):
                ids, _ = beam_search(x, graph, entry, q[at : at + SIDE].astype(np.float32), beam)
                for i, row in enumerate(ids):
                    row = row[row >= 0]
                    gap = exact[row] - q[at + i]
                    far = np.sqrt((gap * gap).sum(axis=1))
                    own, found = names[at + i], []
                    for j in np.argsort(far, kind="stable"):
                        # Nodes as far as the last one found may still hold smaller ids.
                        if len(found) >= k and far[j] > found[-1][0]:
                            break
                        found += [(float(far[j]), m) for m in members[row[j]] if m != own]
                    out += [(own, m, d) for d, m in sorted(found)[:k]]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) that are not null, not zero and wholly finite."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    rows = require(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    # forall over null elements may be null, which counts as false here.
    rows = rows.where(F.coalesce(F.forall("embedding", fine), F.lit(False)) & F.exists("embedding", lambda v: v != 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()


def index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """A graph for each shard of the distinct vectors, and the number of shards.

    Equal vectors are one node. All are equally far from any query and ties go to smaller ids, so only the
    k + 1 smallest ids of a node can be among a query's k nearest other rows; these it keeps.
    """
    rank = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    nodes = cut(few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = parts(nodes.count(), shard_rows)
    keyed = nodes.select(F.size("embedding").alias("dims"), F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"), "embedding", "ids")
    schema = T.StructType([*keyed.schema.fields, T.StructField("place", T.LongType()), T.StructField("edges", T.BinaryType()), T.StructField("entry", T.LongType())])
    return keyed.groupBy("dims", "shard").applyInArrow(_build, schema), shards


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM, shard_rows: int = SHARD_ROWS, block: int = BLOCK_QUERIES) -> DataFrame:
    """The k nearest vectors (vec_id, embedding) of each query (the same columns), by Euclidean distance.

    Vectors are dealt into shards by a hash of their components; each shard's graph is built in one task of
    bounded size. Every query searches every shard of its length, in blocks of `block` queries, and the k
    best of all shards stay. Distances are exact, of the original components in double precision.

    Vectors that are null, zero, empty or hold null or non-finite components, and null ids, take no part. Fewer
    candidates than k: all of them. A query is never its own neighbour, by vec_id. Repeated rows count once;
    a vec_id with several vectors is found by, and searches with, each. Ties: smaller vec_id first. Extra columns
    are left aside. No vectors or queries: no rows.
    Returns query_id, rank (from 1), vec_id, score.
    """
    rows = usable(vectors)
    graph, shards = index(rows, k, shard_rows)
    asked = usable(queries).select(F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("dims"))
    asked = cut(asked)
    blocks = parts(asked.count(), block)
    # The block is a hash, so that it is the same whenever a part is computed again.
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    graph = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dims", "shard", "block"]
    met = graph.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_search(k, beam), "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
