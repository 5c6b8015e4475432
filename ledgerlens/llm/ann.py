"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one for each shard.

Equal vectors are one point of a graph, with as many of their ids as a result can hold (``k`` + 1, the
smallest: ties go to smaller ids).  Points are dealt out to shards of about ``SHARD`` by hash.  In a shard
each vector gets one more component that brings all to the same length, so that the nearest by
Euclidean distance is the one with the largest inner product.  Points go into the graph in batches:
a greedy search from the middle point proposes neighbours; pruning keeps the closest and drops
others that are nearer to a kept one than to the point by a factor of ``ALPHA``, so edges stay diverse; edges
back are added and pruned alike (Subramanya et al., 2019).  Queries go to every shard, in blocks of at most
``BLOCK``: a task holds one shard and one block.  A beam search of width ``BEAM`` collects candidates, which are scored
in double precision on the original vectors, and the best of all shards remain.  Vectors keep their type (float, or
double for any other); only the graph's walk is in single precision, over vectors scaled to components of one at most.

Every row is indexed.  Vectors that are null, zero, hold a null or non-finite component or have another
number of components than most take no part.  Rows that share a vec_id count once (the least hash of the
vector); rows with a null vec_id take no part.  Fewer than ``k`` candidates give fewer rows; an empty table gives none.
Only ``vec_id`` and ``embedding`` are read, whatever other columns exist.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ship, stored

K = 20
SHARD = 8192
BLOCK = 4096
DEGREE, ROOM, ALPHA = 32, 48, 1.2
BUILD_BEAM, BEAM = 64, 96
BATCH = 512
GRAPH = "shard int, n int, dim int, kind string, vectors binary, edges binary, start int, ids binary, ids_n binary"
FOUND = "query_id long, vec_id long, score double"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, h (a hash of the vector) and vector of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = "float" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast(f"array<{kind}>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    rows = rows.withColumn("h", F.xxhash64("embedding"))  # minus zero hashes as zero
    one = rows.groupBy("vec_id").agg(F.min(F.struct("h", "embedding")).alias("v")).select("vec_id", "v.*")
    kept = stored(one, "vectors")
    dims = kept.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return kept.where(F.size("embedding") == (dims.dim if dims else 0))


def prune(x: np.ndarray, points: np.ndarray, cands: np.ndarray, degree: int) -> np.ndarray:
    """For each of ``points`` its robustly pruned neighbours among ``cands`` (a row for each point; -1 for none)."""
    out = np.full((len(points), degree), -1, np.int32)
    for a in range(0, len(points), 256):
        p, c = points[a:a + 256], cands[a:a + 256]
        c = np.where(c == p[:, None], -1, c)
        vc = x[np.maximum(c, 0)]
        to_p = np.maximum(((vc - x[p][:, None]) ** 2).sum(2), 0)
        to_p[c < 0] = np.inf
        square = (vc * vc).sum(2)
        between = np.maximum(square[:, :, None] + square[:, None, :] - 2 * (vc @ vc.transpose(0, 2, 1)), 0)
        row = np.arange(len(p))
        for k in range(degree):
            best = to_p.argmin(1)
            alive = np.isfinite(to_p[row, best])
            if not alive.any():
                break
            out[a:a + len(p), k][alive] = c[row, best][alive]
            d = between[row, best]
            to_p[(ALPHA * ALPHA * d <= to_p) & alive[:, None]] = np.inf
            to_p[row, best] = np.inf
    return out


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Points nearest to each query (by squared distance up to a constant), -1 after the last; all queries step together."""
    n, q = len(x), len(queries)
    norms = (x * x).sum(1)
    seen = np.zeros((q, n + 1), bool)  # the last column stands for no point
    seen[:, n] = True
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.zeros((q, beam), bool)
    ids[:, 0], seen[:, start] = start, True
    dist[:, 0] = norms[start] - 2 * queries @ x[start]
    active = np.arange(q)
    while len(active):
        open_ = np.where(done[active] | (ids[active] < 0), np.inf, dist[active])
        at = open_.argmin(1)
        more = np.isfinite(open_[np.arange(len(active)), at])
        active, at = active[more], at[more]
        if not len(active):
            break
        done[active, at] = True
        near = edges[ids[active, at]].astype(np.int64)
        near[near < 0] = n
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        safe = np.minimum(near, n - 1)
        d = norms[safe] - 2 * np.matmul(x[safe], queries[active][:, :, None])[:, :, 0]
        d = np.where(fresh, d, np.inf).astype(np.float32)
        all_d = np.concatenate([dist[active], d], 1)
        order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        all_i = np.concatenate([ids[active], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[active], np.zeros(d.shape, bool)], 1)
        dist[active] = np.take_along_axis(all_d, order, 1)
        ids[active] = np.where(np.isfinite(dist[active]), np.take_along_axis(all_i, order, 1), -1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return ids, done


def _flat(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A row for each vector, in the column's own type."""
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def walked(vectors: np.ndarray, each: bool = False) -> np.ndarray:
    """Vectors in single precision for the walk; wider ones by the largest component (``each``: its own), which changes no order."""
    if vectors.dtype == np.float32 or not vectors.size:
        return vectors
    # By a power of two, so that no digit is lost.
    top = np.abs(vectors).max(1, keepdims=True) if each else np.abs(vectors).max()
    return np.ldexp(vectors, -np.frexp(top)[1]).astype(np.float32)


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """One more component, so that all have the length of the longest."""
    vectors = walked(vectors)
    square = (vectors.astype(np.float64) ** 2).sum(1)
    return np.concatenate([vectors, np.sqrt(np.maximum(square.max() - square, 0))[:, None].astype(np.float32)], 1)


def build(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges (a row for each point, -1 for none) and the middle point to start from."""
    x = lengthened(vectors)
    n = len(x)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, ROOM), -1, np.int32)
    order = np.random.Generator(np.random.PCG64(n)).permutation(n)
    order = order[order != start]
    at = 0
    while at < len(order):
        new = order[at:at + min(BATCH, max(1, at))]  # batches grow with the graph
        at += len(new)
        found, _ = beam_search(x, edges, start, x[new], BUILD_BEAM)
        chosen = prune(x, new, found, DEGREE)
        edges[new, :DEGREE] = chosen
        # Edges back: appended while there is room, else pruned with those that are there.
        src, col = np.nonzero(chosen >= 0)
        to, frm = chosen[src, col].astype(np.int64), new[src]
        by = np.argsort(to, kind="stable")
        to, frm = to[by], frm[by]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        degree = (edges[target] >= 0).sum(1)
        nth = np.arange(len(to)) - np.repeat(first, count)
        base = np.repeat(degree, count)
        width = int((degree + count).max(initial=0))
        wide = np.full((len(target), max(width, ROOM)), -1, np.int64)
        wide[:, :ROOM] = np.sort(edges[target], axis=1)[:, ::-1]
        wide[np.repeat(np.arange(len(target)), count), base + nth] = frm
        over = degree + count > ROOM
        edges[target[~over]] = wide[~over][:, :ROOM]
        if over.any():
            edges[target[over]] = -1
            edges[target[over], :DEGREE] = prune(x, target[over], wide[over], DEGREE)
    return edges, start


def index(rows: DataFrame, k: int = K, shard: int = SHARD) -> DataFrame:
    """A graph for each shard of ``rows`` (from ``usable``), packed into a row."""
    ship(rows.sparkSession)
    of_class = Window.partitionBy("h").orderBy("vec_id")
    least = rows.select("h", "vec_id").withColumn("nth", F.row_number().over(of_class)).where(F.col("nth") <= k + 1)
    members = least.groupBy("h").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    points = rows.join(members.withColumn("vec_id", F.col("ids")[0]), ["h", "vec_id"]).select("h", "embedding", "ids")
    points = stored(points, "points")
    shards = -(-points.count() // shard) or 1

    def pack(key, table):
        table = table.sort_by("h")
        dim = len(table.column("embedding")[0].as_py())
        vectors = _flat(table.column("embedding"), dim)
        edges, start = build(vectors)
        ids = table.column("ids").combine_chunks()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(vectors)], pa.int32()), "dim": pa.array([dim], pa.int32()), "kind": [vectors.dtype.name],
                         "vectors": [vectors.tobytes()], "edges": [edges.tobytes()], "start": pa.array([start], pa.int32()),
                         "ids": [ids.flatten().to_numpy().tobytes()], "ids_n": [ids.value_lengths().to_numpy().astype(np.int32).tobytes()]})

    dealt = points.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInArrow(pack, GRAPH), "graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest found for each of ``queries`` (vec_id, embedding): query_id, rank, vec_id, score."""
    ship(graphs.sparkSession)
    last = graphs.agg(F.coalesce(F.max("shard"), F.lit(0)).alias("last")).first()["last"]
    blocks = -(-queries.count() // block) or 1

    def look(key, graph, asked):
        out = {"query_id": [], "vec_id": [], "score": []}
        if graph.num_rows and asked.num_rows:
            g = graph.to_pylist()[0]
            x = np.frombuffer(g["vectors"], g["kind"]).reshape(g["n"], g["dim"])
            edges = np.frombuffer(g["edges"], np.int32).reshape(g["n"], -1)
            ids, ids_n = np.frombuffer(g["ids"], np.int64), np.frombuffer(g["ids_n"], np.int32).astype(np.int64)
            first = np.cumsum(ids_n) - ids_n
            q = _flat(asked.column("embedding"), g["dim"])
            own, long = asked.column("vec_id").to_numpy(), lengthened(x)
            for a in range(0, len(q), BATCH):
                part = q[a:a + BATCH]
                found, _ = beam_search(long, edges, g["start"], np.concatenate([walked(part, True), np.zeros((len(part), 1), np.float32)], 1), beam)
                for i, c in enumerate(found):
                    c = c[c >= 0]
                    score = x[c].astype(np.float64) @ part[i].astype(np.float64)
                    n = ids_n[c]
                    vec = ids[np.repeat(first[c] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                    score = np.repeat(score, n)
                    keep = vec != own[a + i]
                    vec, score = vec[keep], score[keep]
                    best = np.lexsort((vec, -score))[:k]
                    out["query_id"].append(np.full(len(best), own[a + i]))
                    out["vec_id"].append(vec[best])
                    out["score"].append(score[best])
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({c: np.concatenate([np.zeros(0, t), *out[c]]).astype(t) for c, t in kinds.items()})

    asked = queries.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    many = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = many.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(look, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(rows: DataFrame, every: int = 20) -> DataFrame:
    """The columns of query op10: the rows whose vec_id is divisible by ``every``, against all."""
    rows = usable(rows)
    return search(index(rows), rows.where(F.col("vec_id") % every == 0))
