"""Approximate nearest neighbours with vantage-point trees, one per shard.

Vectors are scaled to length one, where the order of distances is that of cosines and the
triangle inequality holds. Each shard of the distinct vectors builds a tree of vantage
points: a ball around the point holds the nearer half, the rest lies outside. Queries go down
the tree together. A side is left out if the triangle inequality puts it farther away than ``factor``
times the worst neighbour so far; factor one never leaves out a neighbour (exact search), smaller ones
leave out more.

Equal vectors are one entry with their smallest ids, so many copies of one vector cost nothing
and ties between them are settled by id. Vectors of equal direction and different length have distances that
differ by rounding alone; all entries within rounding distance of the last one wanted are scored exactly. Every row is
indexed. Queries meet every shard in blocks, so a task holds one shard and one block, and builds the tree once for the block.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part;
vectors of different length do not meet; rows that are equal count once; a vector with fewer
candidates than asked for gets all of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlore.llm.shared import stored

#: Distances come from a product of matrices: equal ones differ by less than this.
_ROUNDING = 1e-6


class Nearest:
    """The ``count`` largest exact scores of each query found so far, ties by smaller id."""

    def __init__(self, asked: np.ndarray, names: np.ndarray, table: np.ndarray, ids: list[np.ndarray], count: int):
        self.asked, self.names, self.table, self.count = asked, names, table, count
        self.ids, self.sizes = np.concatenate([*ids, np.zeros(0, np.int64)]), np.array([len(i) for i in ids], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.who, self.scores, self.found = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def offer(self, who: np.ndarray, entry: np.ndarray) -> None:
        """Scores pairs of a query and an entry; an entry stands for all its ids but the query's own."""
        score = cosine(self.asked[who], self.table[entry])
        size = self.sizes[entry]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ids = self.ids[np.repeat(self.first[entry], size) + inside]
        who, score = np.repeat(who, size), np.repeat(score, size)
        other = ids != self.names[who]
        who, score, ids = (np.concatenate(p) for p in ((self.who, who[other]), (self.scores, score[other]), (self.found, ids[other])))
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
        nth = np.arange(len(who)) - np.repeat(starts, np.diff(np.r_[starts, len(who)]))
        kept = nth < self.count
        self.who, self.scores, self.found = who[kept], score[kept], ids[kept]


class Tree:
    """A vantage-point tree over unit vectors."""

    def __init__(self, unit: np.ndarray, leaf: int = 128, seed: int = 42):
        self.unit, self.leaf = unit, leaf
        self.drawn = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(unit)))

    def _grow(self, rows: np.ndarray) -> tuple | np.ndarray:
        if len(rows) <= self.leaf:
            return rows
        point = rows[self.drawn.integers(len(rows))]
        far = _distances(self.unit[point][None], self.unit[rows])[0]
        radius = np.median(far)
        inside = far <= radius
        if inside.all():
            return rows
        ball, rest = rows[inside], rows[~inside]
        # of both sides the range of distances from the point
        return point, far[inside].max(), far[~inside].min(), far[~inside].max(), self._grow(ball), self._grow(rest)

    def search(self, queries: np.ndarray, count: int, factor: float, nearest: Nearest) -> None:
        """Offers ``nearest`` every entry that is met and not farther away than the ``count``-th of those met before.

        Entries at the same distance are all offered, whatever their number, so that their exact scores and ids decide.
        """
        self.best = np.full((len(queries), count), np.inf)
        self._visit(self.root, queries, np.arange(len(queries)), factor, nearest)

    def _visit(self, node: tuple | np.ndarray, queries: np.ndarray, who: np.ndarray, factor: float, nearest: Nearest) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            # a leaf that median radii could not split may hold many equal directions
            for at in range(0, len(node), self.leaf):
                part = node[at : at + self.leaf]
                away = _distances(queries[who], self.unit[part])
                self.best[who] = np.sort(np.c_[self.best[who], away], axis=1)[:, : self.best.shape[1]]
                q, e = np.nonzero(away <= self.best[who, -1][:, None] + _ROUNDING)
                nearest.offer(who[q], part[e])
            return
        point, reach, near, end, ball, rest = node
        away = _distances(queries[who], self.unit[point][None])[:, 0]
        to_ball, to_rest = away - reach, np.maximum(near - away, away - end)
        first = to_ball <= to_rest
        self._visit(ball, queries, who[first], factor, nearest)
        self._visit(rest, queries, who[~first], factor, nearest)
        for side, gap, late in ((rest, to_rest, first), (ball, to_ball, ~first)):
            wanted = late & (gap <= factor * self.best[who, -1] + _ROUNDING)
            self._visit(side, queries, who[wanted], factor, nearest)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows in double precision, each from its own two rows alone."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, each once, with their length."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    some = F.exists(wide, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), wide.alias("embedding"), F.size("embedding").alias("dim")
    ).distinct()


def nearest(vectors: DataFrame, count: int = 5, every: int = 50, factor: float = 0.9, shard: int = 8192,
            block: int = 8192, strip: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the ``count`` nearest of each row whose id ``every`` divides.

    ``strip`` queries at a time go down a tree, which bounds what a leaf compares at once.
    """
    rows = stored(usable(vectors), "vectors")
    order = Window.partitionBy("embedding").orderBy("vec_id")
    ids = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= count + 1)
    entries = stored(
        ids.groupBy("embedding", "dim").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "vector-entries"
    )
    queries = rows.where(F.col("vec_id") % every == 0)
    shards = max(1, -(-entries.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    some = lambda n, *of: F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = entries.select("dim", "embedding", "ids", some(shards, "embedding").alias("shard"), all_of(blocks).alias("block"))
    right = queries.select("dim", "vec_id", "embedding", some(blocks, "vec_id").alias("block"), all_of(shards).alias("shard"))

    def search(indexed: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if indexed.empty or asked.empty:
            return empty
        table, sought = np.stack(indexed["embedding"].to_numpy()), np.stack(asked["embedding"].to_numpy())
        unit = lambda x: x / np.abs(x).max(axis=1, keepdims=True)  # noqa: E731  against overflow
        scaled = lambda x: unit(x) / np.sqrt((unit(x) ** 2).sum(axis=1, keepdims=True))
        tree, names, ids = Tree(scaled(table)), asked["vec_id"].to_numpy(), [np.asarray(i, np.int64) for i in indexed["ids"]]
        out = [empty]
        for at in range(0, len(sought), strip):
            some = slice(at, at + strip)
            met = Nearest(sought[some], names[some], table, ids, count)
            # one more than asked for, as the query may be among them
            tree.search(scaled(sought[some]), count + 1, factor, met)
            out.append(pd.DataFrame({"query_id": names[some][met.who], "vec_id": met.found, "score": met.scores}))
        return pd.concat(out, ignore_index=True)

    keys = ["dim", "shard", "block"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score"
    )
