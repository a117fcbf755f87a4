"""Operator 2, approximate nearest neighbours: robust-pruned directed graphs, one for each shard."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import cut_lineage


class Graph:
    """Directed graph over the rows of x for searches by largest inner product.

    x gets one more component that gives all rows one length, so that the nearest row by distance is the one with the largest
    inner product. Rows are inserted in batches: a greedy search of the graph so far proposes neighbours, and pruning keeps
    the nearest one, drops those that are `alpha` times nearer to it than to the row, and goes on with what is left.
    Edges are also laid back, and lists that get too long are pruned again.
    """

    def __init__(self, x: np.ndarray, longest: float, degree: int = 32, beam: int = 64, alpha: float = 1.2, entries: int = 64, seed: int = 3):
        x = np.ascontiguousarray(x, np.float32)
        rest = np.sqrt(np.maximum(longest * longest - np.einsum("ij,ij->i", x, x, dtype=np.float64), 0)).astype(np.float32)
        self.x, self.degree, self.alpha2 = np.column_stack([x, rest]), degree, alpha * alpha
        n = len(x)
        self.near = np.full((n, degree), -1, np.int32)
        order = np.random.default_rng(seed).permutation(n)
        self.entries = order[:entries]
        first = self.entries
        pool = np.broadcast_to(first, (len(first), len(first))).copy()
        self._link(first, pool)
        at, size = len(first), 64
        while at < n:
            rows = order[at:at + size]
            found, _ = self.search(self.x[rows], beam)
            self._link(rows, found)
            at, size = at + len(rows), min(size * 2, 512)

    def search(self, q: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` rows found for each query, nearest first (-1: none), and their inner products. `width` rows are expanded at a time."""
        out = [self._search(q[i:i + 256], beam, width) for i in range(0, len(q), 256)]
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def _search(self, q, beam, width):
        n, m = len(self.x), len(q)
        size = max(beam, len(self.entries))
        seen = np.zeros((m, n), bool)
        seen[:, self.entries] = True
        ids = np.full((m, size), -1, np.int32)
        score = np.full((m, size), -np.inf, np.float32)
        ids[:, :len(self.entries)] = self.entries
        score[:, :len(self.entries)] = q @ self.x[self.entries].T
        turn = np.argsort(-score, 1, kind="stable")[:, :beam]
        ids, score = np.take_along_axis(ids, turn, 1), np.take_along_axis(score, turn, 1)
        done = ids < 0
        live = np.arange(m)
        while len(live):
            key = np.where(done[live], -np.inf, score[live])
            pick = np.argpartition(-key, min(width, key.shape[1]) - 1, 1)[:, :width]
            good = np.take_along_axis(key, pick, 1) > -np.inf
            keep = good.any(1)
            live, pick, good = live[keep], pick[keep], good[keep]
            if not len(live):
                break
            rows = np.where(good, ids[live[:, None], pick], -1)
            done[live[:, None], pick] = True
            new = np.where((rows >= 0)[:, :, None], self.near[rows], -1)
            for k in range(new.shape[1]):  # a row proposed twice counts once
                c = new[:, k]
                c[seen[live[:, None], np.maximum(c, 0)] & (c >= 0)] = -1
                r, j = np.nonzero(c >= 0)
                seen[live[r], c[r, j]] = True
            new = new.reshape(len(live), -1)
            s = np.matmul(self.x[np.maximum(new, 0)], q[live][:, :, None])[:, :, 0]
            s[new < 0] = -np.inf
            every = np.concatenate([score[live], s], 1)
            turn = np.argpartition(-every, beam - 1, 1)[:, :beam]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], 1), turn, 1)
            score[live] = np.take_along_axis(every, turn, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], new < 0], 1), turn, 1)
        turn = np.argsort(-score, 1, kind="stable")
        return np.take_along_axis(ids, turn, 1), np.take_along_axis(score, turn, 1)

    def _prune(self, rows: np.ndarray, pool: np.ndarray) -> np.ndarray:
        """Up to `degree` diverse neighbours of each row out of its pool (-1: none)."""
        x = self.x
        ok = (pool >= 0) & (pool != rows[:, None])
        c = x[np.maximum(pool, 0)]
        sq = np.einsum("abd,abd->ab", c, c)
        p = x[rows]
        far = np.maximum(sq + np.einsum("ad,ad->a", p, p)[:, None] - 2 * np.matmul(c, p[:, :, None])[:, :, 0], 0)
        between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(c, c.transpose(0, 2, 1)), 0)
        out = np.full((len(rows), self.degree), -1, np.int32)
        all_ = np.arange(len(rows))
        for k in range(self.degree):
            d = np.where(ok, far, np.inf)
            best = d.argmin(1)
            some = d[all_, best] < np.inf
            if not some.any():
                break
            out[some, k] = pool[all_, best][some]
            ok &= self.alpha2 * between[all_, best] > far
            ok[all_, best] = False
        return out

    def _link(self, rows: np.ndarray, pool: np.ndarray) -> None:
        for i in range(0, len(rows), 256):
            self.near[rows[i:i + 256]] = self._prune(rows[i:i + 256], pool[i:i + 256])
        src, slot = np.nonzero(self.near[rows] >= 0)
        to, back = self.near[rows][src, slot], rows[src]
        turn = np.argsort(to, kind="stable")
        to, back = to[turn], back[turn]
        ends, begin, many = np.unique(to, return_index=True, return_counts=True)
        nth = np.arange(len(to)) - np.repeat(begin, many)
        for g in range(0, len(ends), 256):
            e, b, n = ends[g:g + 256], begin[g:g + 256], many[g:g + 256]
            fresh = np.full((len(e), n.max()), -1, np.int32)
            part = slice(b[0], b[-1] + n[-1])
            fresh[np.repeat(np.arange(len(e)), n), nth[part]] = back[part]
            had = self.near[e]
            fresh[(fresh[:, :, None] == had[:, None, :]).any(2)] = -1  # edges that are there already
            both = np.concatenate([had, fresh], 1)
            over = (both >= 0).sum(1) > self.degree
            both_first = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
            self.near[e[~over]] = both_first[~over][:, :self.degree]
            if over.any():
                self.near[e[over]] = self._prune(e[over], both[over])


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """(vec_id, v): the vectors that take part, once for each id."""
    x = F.col(vec).cast("array<float>")
    ok = (F.col("vec_id").isNotNull() & F.col(vec).isNotNull() & (F.size(x) > 0)
          & F.forall(x, lambda a: F.coalesce(~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))), F.lit(False)))
          & F.exists(x, lambda a: a != 0))
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v")).distinct()


def search(vectors: DataFrame, every: int = 20, k: int = 20, vec: str = "embedding", beam: int = 128, degree: int = 32,
           shards: int = 12, shard_rows: int = 1 << 16) -> DataFrame:
    """The k nearest found for each row whose vec_id is divisible by `every`: query_id, rank (from 1), vec_id, score.

    Nearness is the largest inner product; score is it in double precision on the vectors as given; ties go to the
    smaller vec_id; the query's own id is no candidate. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without an id; vectors of another dimension are never compared. Equal
    vectors are one node of the graph with its k + 1 smallest ids, more than any query can use, so that a
    vector held by a third of the rows is searched once. Nodes are dealt over shards by hash, each of at most about
    shard_rows nodes; each shard streams in its nodes, builds its graph and answers all queries in blocks by beam search;
    the best of all shards are merged. With fewer candidates than k all are found. An empty table gives no rows.
    """
    v = usable(vectors, vec)
    first = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    nodes = cut_lineage(v.withColumn("_k", first).filter(F.col("_k") <= k + 1).groupBy("v")
                         .agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("node", F.get("ids", F.lit(0))))
    asked = cut_lineage(v.filter(F.col("vec_id") % every == 0).join(nodes, "v").select(F.col("vec_id").alias("query_id"), "node"))
    n, longest = nodes.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()
    shards = max(shards, -(-n // shard_rows))
    dim = F.size("v").alias("dim")
    held = nodes.select(F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), dim, F.lit(0).alias("kind"), "node", "v", "ids")
    heads = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    sent = heads.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), dim, F.lit(1).alias("kind"), "node", "v",
                        F.array().cast("array<long>").alias("ids"))

    def answer(graph, x, ids, asked_nodes, q):
        q64 = q.astype(np.float64)
        found, _ = graph.search(np.column_stack([q, np.zeros(len(q), np.float32)]), beam)
        out = [[], [], []]
        for a, row, f in zip(asked_nodes, q64, found):
            f = f[f >= 0]
            s = x[f].astype(np.float64) @ row
            pairs = sorted((-float(z), i) for z, j in zip(s, f) for i in ids[j])[:k + 1]
            out[0] += [a] * len(pairs)
            out[1] += [i for _, i in pairs]
            out[2] += [-z for z, _ in pairs]
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["asked", "vec_id", "score"])

    def run(batches):
        now, xs, ids, graph, x = None, [], [], None, None
        for b in batches:
            places = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
            at = 0
            while at < len(places):  # runs of equal (shard, dim, kind)
                end = at
                while end < len(places) and places[end] == places[at]:
                    end += 1
                part, (shard_, d, kind) = b.slice(at, end - at), places[at]
                at = end
                flat = part.column(4).flatten().to_numpy().astype(np.float32).reshape(-1, d)
                if (shard_, d) != now:
                    now, xs, ids, graph = (shard_, d), [], [], None
                if kind == 0:
                    xs.append(flat)
                    ids += part.column(5).to_pylist()
                elif xs:
                    if graph is None:
                        x = np.concatenate(xs)
                        graph = Graph(x, float(longest), degree)
                    for i in range(0, len(flat), 1024):
                        yield answer(graph, x, ids, part.column(3).to_pylist()[i:i + 1024], flat[i:i + 1024])

    stream = held.union(sent).repartition(4 * shards, "shard").sortWithinPartitions("shard", "dim", "kind", "node")
    found = stream.mapInArrow(run, "asked long, vec_id long, score double")
    best = W.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id")
    merged = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r")
    own = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (asked.join(merged, asked.node == merged.asked).filter("vec_id <> query_id").withColumn("rank", F.row_number().over(own))
                 .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
