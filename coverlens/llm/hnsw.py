"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Rows are dealt to shards by a hash of their id: ``ceil(rows / SHARD_ROWS)`` of them, ``SHARDS`` at least, so a shard fits a task however large the
table.  Each shard holds a hierarchical graph in flat arrays (``-1`` where a slot is free) and answers every query; the shards' best are
merged.  Inner product is turned into nearness on a sphere by one more coordinate (the root of what a vector's square lacks to the
shard's largest), so the graph's greedy walks are sound for any vectors.  Equal vectors of a shard are one vertex that keeps its ``k + 1`` smallest ids:
with ties going to smaller ids no other can be among the nearest ``k``.  Scores are recomputed in double precision from the original vectors.

Vectors that are null, zero, of another length than most or hold null or non-finite components take no part, nor do null ids.  A
query's own row is no candidate; a query with fewer candidates than ``k`` gets all.  Repeated ids are rows of one id and are returned as often
as they stand among the nearest.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.llm.files import FlatFile, mapped
from coverlens.session import materialise, scratch_path

SHARDS, SHARD_ROWS, BLOCK_ROWS = 12, 100_000, 1_000_000  # of the table's rows, for each block of queries
LINKS = 12  # per vertex and level; twice as many on the ground level
BUILD, SEARCH = 48, 64  # breadth of the search while building and while answering


class Graph:
    """A hierarchical small-world graph over the rows of a matrix, nearness by inner product on a sphere."""

    def __init__(self, vectors: np.ndarray, seed: int = 5) -> None:
        squares = np.einsum("ij,ij->i", vectors, vectors)
        rest = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0))
        self.x = np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)
        n = len(self.x)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(1 - draw) / math.log(LINKS)).astype(int), 12)
        self.flat = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, dtype=np.int32) for k in range(int(self.level.max(initial=0)) + 1)]
        self.top = 0
        self._mark = np.zeros(n, dtype=np.int64)
        self._round = 0
        for i in range(1, n):
            self._insert(i)

    def arrays(self) -> dict[str, np.ndarray]:
        """The graph as flat arrays."""
        return {"x": self.x, "level": self.level, "top": np.array(self.top), **{f"flat{k}": f for k, f in enumerate(self.flat)}}

    @classmethod
    def stored(cls, arrays) -> Graph:
        graph = cls.__new__(cls)
        graph.x, graph.level, graph.top = arrays["x"], arrays["level"], int(arrays["top"])
        graph.flat = [arrays[f"flat{k}"] for k in range(int(graph.level.max(initial=0)) + 1)]
        graph._mark, graph._round = np.zeros(len(graph.x), dtype=np.int64), 0
        return graph

    def _near(self, q: np.ndarray, entry: list[int], breadth: int, level: int) -> list[tuple[float, int]]:
        """The nearest found of a level, nearest first."""
        self._round += 1
        mark, flat, x = self._mark, self.flat[level], self.x
        mark[entry] = self._round
        found = [(float(s), i) for s, i in zip(x[entry] @ q, entry, strict=True)]
        todo = [(-s, i) for s, i in found]
        heapq.heapify(todo)
        heapq.heapify(found)
        while todo:
            far, i = heapq.heappop(todo)
            if len(found) >= breadth and -far < found[0][0]:
                break
            near = flat[i]
            near = near[near >= 0]
            near = near[mark[near] != self._round]
            if not len(near):
                continue
            mark[near] = self._round
            scores = x[near] @ q
            if len(found) >= breadth:
                better = scores > found[0][0]
                near, scores = near[better], scores[better]
            for s, j in zip(scores.tolist(), near.tolist(), strict=True):
                if len(found) < breadth:
                    heapq.heappush(found, (s, j))
                    heapq.heappush(todo, (-s, j))
                elif s > found[0][0]:
                    heapq.heapreplace(found, (s, j))
                    heapq.heappush(todo, (-s, j))
        return sorted(found, reverse=True)

    def _descend(self, q: np.ndarray, to: int) -> int:
        at = self.top
        for level in range(int(self.level[at]), to, -1):
            at = self._near(q, [at], 1, level)[0][1]
        return at

    def _choose(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: each nearer to the vertex than to any chosen before, then the nearest of the rest."""
        ids = np.array([j for _, j in near])
        if len(ids) <= most:
            return ids.tolist()
        among = self.x[ids] @ self.x[ids].T
        own = np.array([s for s, _ in near])
        chosen: list[int] = []
        closest = np.full(len(ids), -np.inf)
        for k in range(len(ids)):
            if closest[k] < own[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[k], out=closest)
        rest = [k for k in range(len(ids)) if k not in set(chosen)]
        return ids[(chosen + rest)[:most]].tolist()

    def _insert(self, i: int) -> None:
        q, top = self.x[i], int(self.level[self.top])
        own = int(self.level[i])
        at = [self._descend(q, own)] if own < top else [self.top]
        for level in range(min(own, top), -1, -1):
            near = self._near(q, at, BUILD, level)
            flat = self.flat[level]
            chosen = self._choose(near, LINKS)
            flat[i, : len(chosen)] = chosen
            for j in chosen:
                slots = flat[j]
                free = np.flatnonzero(slots < 0)
                if len(free):
                    slots[free[0]] = i
                else:
                    others = np.append(slots, i)
                    scores = self.x[others] @ self.x[j]
                    order = np.argsort(-scores, kind="stable")
                    slots[:] = self._choose([(float(scores[o]), int(others[o])) for o in order], len(slots))
            at = [j for _, j in near]
        if own > top:
            self.top = i

    def search(self, q: np.ndarray, breadth: int) -> list[int]:
        """Rows of the nearest found."""
        q = np.append(q, 0).astype(np.float32)
        return [i for _, i in self._near(q, [self._descend(q, 0)], breadth, 0)]


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    return (
        vector.isNotNull()
        & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vector = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vec")).where(F.col("id").isNotNull())
    return rows.where(usable(F.col("vec")))


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", shards: int | None = None) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each row of ``df`` that ``is_query`` (over column ``id``) selects."""
    rows = materialise(_vectors(df, id_col, vec_col), "vectors")
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    most = sizes[0] if sizes else {"d": 0, "n": 0}
    rows = rows.where(F.size("vec") == most["d"])
    shards = shards or max(SHARDS, -(-most["n"] // SHARD_ROWS))
    breadth = max(SEARCH, k + 1)

    folder = scratch_path(df.sparkSession, "hnsw")

    def build(key: tuple, stored: pd.DataFrame) -> pd.DataFrame:
        stored = stored.sort_values("id", kind="stable")
        matrix = np.ascontiguousarray(np.vstack(stored["vec"].to_numpy()), dtype=np.float64)
        whole = matrix.view(np.dtype((np.void, matrix.shape[1] * 8))).ravel()
        _, first, back = np.unique(whole, return_index=True, return_inverse=True)
        order = np.argsort(back, kind="stable")
        cuts = np.searchsorted(back[order], np.arange(len(first) + 1))
        kept = np.concatenate([order[a : min(b, a + k + 1)] for a, b in zip(cuts, cuts[1:], strict=False)])
        cuts = np.cumsum([0, *np.minimum(np.diff(cuts), k + 1)])
        packed = io.BytesIO()
        np.savez(packed, ids=stored["id"].to_numpy()[kept], cuts=cuts, vectors=matrix[first], **Graph(matrix[first]).arrays())
        file = FlatFile(f"{folder}/{key[0]:05d}.npz")
        file.write(packed.getvalue())
        file.close()
        return pd.DataFrame({"shard": [key[0]], "rows": [len(stored)]})

    def answer(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        shard = np.load(io.BytesIO(mapped(f"{folder}/{key[0]:05d}.npz", np.dtype(np.uint8)).tobytes()))
        graph, ids, cuts, vectors = Graph.stored(shard), shard["ids"], shard["cuts"], shard["vectors"]
        out = []
        for query, vector in zip(asked["id"], asked["vec"], strict=True):
            vector = np.asarray(vector, dtype=np.float64)
            near = np.array(graph.search(vector, breadth))
            score = np.repeat((vectors[near] * vector).sum(axis=1), cuts[near + 1] - cuts[near])
            found = np.concatenate([ids[cuts[v] : cuts[v + 1]] for v in near])
            score, found = score[found != query], found[found != query]
            best = np.lexsort((found, -score))[:k]
            out.append(pd.DataFrame({"query_id": query, "id": found[best], "score": score[best]}))
        return pd.concat(out)

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    built = materialise(sharded.groupBy("shard").applyInPandas(build, "shard int, rows long"), "hnsw-shards")
    # Every shard answers every query, in blocks of queries: a task holds one shard's graph and one block.
    asked = rows.where(is_query).dropDuplicates(["id"])
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(max(1, -(-most["n"] // BLOCK_ROWS)))))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(built.select("shard"), "shard", "left_semi")
    found = asked.groupBy("shard", "block").applyInPandas(answer, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
