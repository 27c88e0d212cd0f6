"""Exact top-k search by inner product with M-trees.

Maximum inner product is nearest-neighbour search in a metric space: with M
the largest norm of a shard, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a
query q becomes (q, 0), and their distance falls as q.x grows.  Each shard of
the rows has an M-tree over these points: pages of routing entries with a
pivot, a covering radius, the distance to the page's own pivot and the
smallest id below, and leaf pages of points with their distance to the
page's pivot.

Queries walk a tree in blocks, each first down to the best child of a page.
A bound on an entry's score comes from the stored distance to the parent by
the triangle inequality, without computing a distance; only entries that pass
it are measured, and measured entries are bounded again by their covering
radius.  Scores are exact integers and ties go to the smaller id, so a page
whose bound equals the k-th score is skipped only if its smallest id is
larger.

Trees are built and searched in Spark tasks: shards of about ``SHARD_ROWS``
rows by a hash of the id, queries in blocks of ``QUERY_BLOCK`` that go to
every shard, then a top-k per query.  A task has one tree at a time, built
where it is searched, and meets up to ``PART_BLOCKS`` blocks with it, so its
memory follows neither the number of rows nor that of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm.components import written
from wardstat.llm.ship import ship

SHARD_ROWS = 8192
QUERY_BLOCK = 512
PART_BLOCKS = 64  # blocks of queries that one build of a tree answers
MOST_TASKS = 10_000
FANOUT = 16
LEAF = 768


def quantised(vector_col: str = "embedding", factor: int = 256) -> Column:
    """floor(factor * x) of every component as long; null where the vector is
    null or holds a null, NaN or infinite component."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long")))


class MTree:
    """An M-tree over integer vectors (rows of ``x``) with ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order].astype(np.int64)
        f = self.x.astype(np.float64)
        norm2 = (f * f).sum(1)
        self.m2 = float(norm2.max(initial=0.0))
        self.extra = np.sqrt(np.maximum(self.m2 - norm2, 0))
        self.points = np.column_stack((f, self.extra))
        # integer products fit a double exactly if they are below 2^53
        self.exact = self.m2 < 2.0**50
        self.pages: list[dict] = []
        # each row's leaf page and its place there
        self.leaf_of, self.place = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        self.rng = np.random.default_rng(len(ids))
        self.top = self._page(np.arange(len(ids)), 0) if len(ids) else -1
        del self.rng

    def _distances(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        d = self.points[rows] - self.points[pivot]
        return np.sqrt((d * d).sum(1))

    def _page(self, rows: np.ndarray, pivot: int) -> int:
        number = len(self.pages)
        self.pages.append({})
        own = self._distances(rows, pivot)
        if len(rows) <= LEAF:
            order = np.argsort(own, kind="stable")
            rows = rows[order]
            self.leaf_of[rows], self.place[rows] = number, np.arange(len(rows))
            self.pages[number] = {"leaf": True, "rows": rows, "to_parent": own[order], "x": self.points[rows, :-1]}
            return number
        picks = self.rng.choice(rows, FANOUT, replace=False)
        nearest, best = np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
        for k, p in enumerate(picks):
            d = self._distances(rows, p)
            closer = d < best
            nearest[closer], best[closer] = k, d[closer]
        groups = [(picks[k], rows[nearest == k]) for k in range(FANOUT) if (nearest == k).any()]
        if len(groups) == 1:  # copies of one point: pages in id order
            groups = [(rows[at], rows[at : at + LEAF]) for at in range(0, len(rows), LEAF)]
        children, pivots, radius = [], [], []
        for p, part in groups:
            pivots.append(p)
            radius.append(self._distances(part, p).max())
            children.append(self._page(part, p))
        self.pages[number] = {
            "leaf": False, "pivots": np.array(pivots), "radius": np.array(radius), "children": children,
            "to_parent": self._distances(np.array(pivots), pivot), "smallest": np.array([self.ids[part].min() for _, part in groups]),
        }
        return number

    def search(self, q: np.ndarray, k: int, own_id: int) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id), the query's own id left out, and how many
        scores were computed."""
        found = Search(self, q[None], k, np.array([own_id]))
        _, ids, scores = found.best()
        return list(zip(scores.tolist(), ids.tolist(), strict=True)), found.computed


class Search:
    """A tree's ``k`` best rows for each row of ``queries``, whose ids are
    ``own`` and are left out.

    The queries walk the tree together: at a routing page each first goes
    down to its best child, then to those of the others that its bounds
    still let it, so a page is one matrix product for all queries that need
    it.
    """

    def __init__(self, tree: MTree, queries: np.ndarray, k: int, own: np.ndarray):
        self.tree, self.k, self.own, self.computed = tree, k, own, 0
        self.q = queries.astype(np.int64)
        self.qf = queries.astype(np.float64)
        q2 = (self.qf * self.qf).sum(1)
        self.exact = tree.exact and bool((q2 < 2.0**50).all())
        self.half = (q2 + tree.m2) / 2
        self.slack = 1e-9 * (q2 + tree.m2) + 1e-6
        kind = np.float64 if self.exact else np.int64
        # no score is as low as an empty place
        self.empty, self.no = (-np.finfo(kind).max, -np.inf) if self.exact else (np.iinfo(kind).min + 1, np.iinfo(kind).min)
        self.scores = np.full((len(queries), max(k, 1)), self.empty, kind)
        self.ids = np.full(self.scores.shape, np.iinfo(np.int64).max)
        if tree.top < 0 or k <= 0 or not len(queries):
            return
        # the rows of the queries' own ids
        first, last = np.searchsorted(tree.ids, own, "left"), np.searchsorted(tree.ids, own, "right")
        self.own_query = np.repeat(np.arange(len(own)), last - first)
        self.own_row = np.arange(len(self.own_query)) + np.repeat(first - np.cumsum(last - first) + (last - first), last - first)
        at = 2 * self.half - 2 * (self.qf @ tree.points[0, :-1])
        with np.errstate(over="ignore"):
            self._visit(tree.top, np.arange(len(queries)), np.sqrt(np.maximum(at, 0)))

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's position, id, score), the best of a query first."""
        query, place = np.nonzero(self.scores != self.empty)
        return query, self.ids[query, place], self.scores[query, place].astype(np.int64)

    def _products(self, rows: np.ndarray, points: np.ndarray, who: np.ndarray) -> np.ndarray:
        self.computed += len(rows) * len(who)
        # matrix products of integers don't run in parallel units, those of doubles do
        return self.qf[who] @ points.T if self.exact else self.q[who] @ self.tree.x[rows].T

    def _bound(self, distance: np.ndarray, who: np.ndarray) -> np.ndarray:
        """The largest score at that distance or beyond."""
        return self.half[who, None] - np.maximum(distance, 0) ** 2 / 2 + self.slack[who, None]

    def _visit(self, number: int, who: np.ndarray, distance: np.ndarray) -> None:
        """distance: of the queries ``who`` from the page's pivot."""
        page = self.tree.pages[number]
        if page["leaf"]:
            return self._leaf(number, page, who, distance)
        may = self._bound(np.abs(distance[:, None] - page["to_parent"]) - page["radius"], who) >= self.scores[who, -1:]
        entries = np.flatnonzero(may.any(0))
        if not len(entries):
            return
        rows = page["pivots"][entries]
        s = self._products(rows, self.tree.points[rows, :-1], who).astype(np.float64)
        d = np.sqrt(np.maximum(2 * self.half[who, None] - 2 * s, 0))
        radius = page["radius"][entries]
        # all points of an entry without extent have its pivot's score
        best = np.where(radius == 0, s, self._bound(d - radius, who))
        best[~may[:, entries]] = -np.inf
        nearest = best.argmax(1)
        order = np.argsort(-best.max(0), kind="stable")
        for again in (False, True):
            for j in order:
                smallest, last = page["smallest"][entries[j]], self.scores[who, -1].astype(np.float64)
                top = np.floor(best[:, j])
                use = np.flatnonzero(((nearest == j) ^ again) & ((top > last) | (top == last) & (smallest <= self.ids[who, -1])))
                if len(use):
                    self._visit(page["children"][entries[j]], who[use], d[use, j])
        return None

    def _leaf(self, number: int, page: dict, who: np.ndarray, distance: np.ndarray) -> None:
        tree, k = self.tree, self.k
        # a row is as far from the query as their distances from the pivot differ, at least
        reach = np.sqrt(np.maximum(2 * (self.half[who] + self.slack[who] - self.scores[who, -1].astype(np.float64)), 0))
        reach += 1e-9 * (distance + reach) + 1e-9
        near = (distance - reach <= page["to_parent"][-1]) & (distance + reach >= page["to_parent"][0])
        if not near.any():
            return
        who, distance, reach = who[near], distance[near], reach[near]
        some = slice(*np.searchsorted(page["to_parent"], [(distance - reach).min(), np.nextafter((distance + reach).max(), np.inf)]))
        rows = page["rows"][some]
        s = self._products(rows, page["x"][some], who)
        own = np.flatnonzero(tree.leaf_of[self.own_row] == number)
        if len(own):
            place = tree.place[self.own_row[own]] - some.start
            at = np.minimum(np.searchsorted(who, self.own_query[own]), len(who) - 1)
            here = (who[at] == self.own_query[own]) & (place >= 0) & (place < len(rows))
            s[at[here], place[here]] = self.no
        low = self.scores[who, -1].copy()
        many = np.flatnonzero((s >= low[:, None]).sum(1) > 4 * k)
        if len(many):  # none below their own k-th
            low[many] = np.maximum(low[many], np.partition(s[many], -k, axis=1)[:, -k])
        query, place = np.nonzero(s >= low[:, None])
        if not len(query):
            return
        # the k best of those before and these, ties to smaller ids
        new = np.unique(query)
        query, scores = np.concatenate((np.repeat(new, k), query)), np.concatenate((self.scores[who[new]].ravel(), s[query, place]))
        ids = np.concatenate((self.ids[who[new]].ravel(), tree.ids[rows[place]]))
        order = np.lexsort((ids, -scores, query))
        starts = np.searchsorted(query[order], new)
        order = order[(starts[:, None] + np.arange(k)).ravel()].reshape(-1, k)
        self.scores[who[new]], self.ids[who[new]] = scores[order], ids[order]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "v") -> DataFrame:
    """(query_id, rank from 1, id, score) of each query's ``k`` largest integer
    inner products with the other rows, ties to the smaller id; all of them
    if there are fewer.

    ``vector_col`` holds arrays of long (see ``quantised``).  Rows with a null
    id or a null vector take no part; vectors meet those of as many
    components only.  Rows that share an id are candidates each for itself,
    but never for a query of that id.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = written(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.size(vector_col).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("q"))
        .filter("id is not null and v is not null"),
        "top-k-vectors",
    )
    n = good.agg(F.count(F.lit(1)).alias("rows"), F.count_if("q").alias("queries"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    shards = max(1, -(-n.rows // SHARD_ROWS))
    blocks = max(1, -(-n.queries // QUERY_BLOCK))
    parts = max(1, -(-blocks // PART_BLOCKS))
    # components travel in the fewest bytes that hold them all
    kind = next(t for t, bits in (("smallint", 15), ("int", 31), ("bigint", 63)) if bits == 63 or max(n.high or 0, -1 - (n.low or 0)) < 1 << bits)
    small = F.col("v").cast(f"array<{kind}>")
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    rows = good.select(shard.alias("shard"), "dim", "id", small.alias("v"), every(parts).alias("part"))
    queries = (
        good.filter("q").select("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.struct("id", small.alias("v")).alias("x"))
        .groupBy("dim", "block").agg(F.collect_list("x").alias("queries"))
        .select("dim", "queries", F.pmod("block", F.lit(parts)).cast("int").alias("part"), every(shards).alias("shard"))
    )

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if rows.num_rows and queries.num_rows:
            dim = rows.column("dim")[0].as_py()
            tree = MTree(rows.column("id").to_numpy(), _matrix(rows.column("v").combine_chunks(), dim))
            asked = pa.concat_arrays([c.flatten() for c in queries.column("queries").chunks])
            own, x = asked.field("id").to_numpy(), _matrix(asked.field("v"), dim)
            for at in range(0, len(own), QUERY_BLOCK):
                some = slice(at, at + QUERY_BLOCK)
                query, ids, scores = Search(tree, x[some], k, own[some]).best()
                out.append((own[some][query], ids, scores))
        return pa.table(dict(zip(("query_id", "id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    # a group is a shard's rows and a part of the queries; a task for each, as their work isn't seen in their bytes
    key, tasks = ["shard", "dim", "part"], min(shards * parts, MOST_TASKS)
    rows, queries = (t.repartition(tasks, *key).groupBy(*key) for t in (rows, queries))
    found = rows.cogroup(queries).applyInArrow(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
