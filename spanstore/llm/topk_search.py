"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors become integers ``floor(1024 x)``.  Equal vectors keep their ``k + 1``
smallest ids (no other can be in an answer), so a crowd of copies costs
nothing.  Rows go to the nearest of some pivots, whose number grows with the
data up to ``MAX_PIVOTS``; a cell is cut into shells around its pivot, blocks of
about ``BLOCK_ROWS`` with radii of their own.  Queries near each other form groups
of at most about ``QUERY_ROWS``.  A query group meets a block in one task, where both are indexed by cover trees
and searched together: a pair of nodes is left out when

    cq.cp + rq |cp| + rp |cq| + rq rp

(centres c, covering radii r) is below the worst kth score of the queries in
the query node.  A first round against one near block gives every query a floor
for that score; the second joins a group only to blocks that can still beat it.

Edge cases: null vectors and vectors with null or non-finite components take no
part, nor do those whose squared length, scaled, reaches 2^62, since 64 bits would not hold
their scores (by Cauchy and Schwarz they hold all others); shorter vectors count as padded with zeros; a query never meets its own
row; fewer than k candidates give fewer rows; ties go to the smaller id; rows
with a null id are left out; rows that repeat id and vector count once, and an id
with several vectors keeps them all; an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import groups_for, scratch, stored, table

K = 10
SCALE = 1024
PIVOTS = 64
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
MAX_PIVOTS = 4096
SHELLS = 16
MAX_SQUARE = 1 << 62
BOUND_CELLS = 1 << 23
LEAF = 24
BASE = 1.3
FOUND = "query_id long, vec_id long, score long"


def quantized(vector: Column) -> Column:
    """``floor(SCALE x)`` of each component as long; null if the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    long = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x.cast("double") * SCALE) * (x.cast("double") * SCALE)) >= float(MAX_SQUARE)
    return F.when(vector.isNotNull() & fine & ~long, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


class CoverTree:
    """Nested nets: the children of a node of covering radius r are centres at
    least r / BASE apart that cover its points within r / BASE."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.norm = np.sqrt((self.points**2).sum(axis=1))
        self.radius: list[float] = []
        self.center: list[int] = []
        self.rows: list[np.ndarray] = []
        self.kids: list[np.ndarray] = []
        if len(points):
            self._build(np.arange(len(points)), 0)

    def _far(self, rows: np.ndarray, center: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[center]) ** 2).sum(axis=1))

    def _build(self, rows: np.ndarray, center: int) -> int:
        near = self._far(rows, center)
        me = len(self.radius)
        self.radius.append(float(near.max()) * (1 + 1e-12))
        self.center.append(center)
        self.rows.append(rows)
        self.kids.append(np.zeros(0, np.int64))
        if len(rows) > LEAF and near.max() > 0:
            reach, owner, centers = near.max() / BASE, np.zeros(len(rows), np.int64), [center]
            while near.max() > reach:
                far = int(near.argmax())
                d = self._far(rows, int(rows[far]))
                closer = d < near
                near[closer], owner[closer] = d[closer], len(centers)
                centers.append(int(rows[far]))
            self.kids[me] = np.asarray([self._build(rows[owner == i], c) for i, c in enumerate(centers)])
        return me


def dual_search(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query id, vector id, score) of each query's k best in ``data``; none below the query's floor."""
    q, p = CoverTree(queries), CoverTree(data)
    exact = max(abs(queries).max(initial=0), abs(data).max(initial=0)) < 1 << 21  # doubles hold the products
    left, right = (q.points, p.points) if exact else (queries, data)
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    worst = floors.astype(np.float64).copy()

    def meet(a: np.ndarray, b: np.ndarray) -> None:
        scores = (left[a] @ right[b].T).astype(np.int64)
        for i, row in zip(a.tolist(), scores):
            ok = np.flatnonzero((row >= worst[i]) & (data_ids[b] != query_ids[i]))
            if len(ok):
                both = best[i] + [(-int(row[j]), int(data_ids[b[j]])) for j in ok]
                best[i] = sorted(both)[:k]
                if len(best[i]) == k:
                    worst[i] = max(worst[i], -best[i][-1][0])

    def visit(x: int, ys: np.ndarray) -> None:
        cq, rq, nq = q.points[q.center[x]], q.radius[x], q.norm[q.center[x]]
        centers = np.asarray([p.center[y] for y in ys])
        radii = np.asarray([p.radius[y] for y in ys])
        bound = p.points[centers] @ cq + rq * p.norm[centers] + radii * nq + rq * radii
        bound += 1e-9 * (np.abs(bound) + (nq + rq) * (p.norm[centers] + radii)) + 1e-6
        leaf = not len(q.kids[x])
        singles = []
        for i in np.argsort(-bound, kind="stable").tolist():
            if bound[i] < worst[q.rows[x]].min():
                break
            y = int(ys[i])
            if not leaf:
                for kid in q.kids[x].tolist():
                    visit(kid, p.kids[y] if len(p.kids[y]) else ys[i : i + 1])
            elif len(p.kids[y]):
                visit(x, p.kids[y])
            else:
                singles.append(p.rows[y])
                if sum(map(len, singles)) >= 4 * LEAF:
                    meet(q.rows[x], np.concatenate(singles))
                    singles = []
        if singles:
            meet(q.rows[x], np.concatenate(singles))

    if len(queries) and len(data):
        visit(0, np.asarray([0]))
    return [(int(query_ids[i]), v, -s) for i, found in enumerate(best) for s, v in found]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _search(data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best k of each (query, block) pair.  data: (block, group, vec_id, v); queries: (block, group, vec_id, v, floor)."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        width = max(map(len, [*left["v"], *right["v"]]))
        got = dual_search(
            _matrix(right["v"], width), right["vec_id"].to_numpy(), right["floor"].to_numpy(np.float64),
            _matrix(left["v"], width), left["vec_id"].to_numpy(), k,
        )
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("block", "group")
    return data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _with_blocks(placed: DataFrame, shells: DataFrame) -> DataFrame:
    """Adds ``block`` = cell:shell:part to rows with (vec_id, cell, far); shells: one row a cell with its cuts.  Other cells drop out."""
    shell = F.size(F.filter("cuts", lambda c: c < F.col("far")))
    return placed.join(F.broadcast(shells), "cell").withColumn("block", F.concat_ws(":", "cell", shell, F.pmod(F.xxhash64("vec_id"), F.col("parts")))).drop("cuts", "parts")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries``; both (vec_id, v)."""
    with scratch(vectors.sparkSession) as keep:
        return keep(stored(_top_k(vectors, queries, k, pivots)))


def _top_k(vectors: DataFrame, queries: DataFrame, k: int, pivots: int) -> DataFrame:
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "v").distinct()
    # Of equal vectors only the k + 1 smallest ids can be in an answer (one may be the query's own).
    copies = Window.partitionBy("v").orderBy("vec_id")
    distinct = stored(vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"))
    pivots = min(MAX_PIVOTS, max(pivots, groups_for(distinct.count(), BLOCK_ROWS)))
    # At most MAX_PIVOTS vectors.
    chosen = distinct.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shared = spark.sparkContext.broadcast([np.asarray(r["v"], np.float64) for r in chosen])

    @F.pandas_udf("struct<cell:int,far:double>")
    def nearest(v: pd.Series) -> pd.DataFrame:
        width = max([len(c) for c in shared.value] + [len(x) for x in v])
        centers = np.stack([np.pad(c, (0, width - len(c))) for c in shared.value])
        cells, far = [np.zeros(0, np.int32)], [np.zeros(0)]
        step = max(1, BOUND_CELLS // len(centers))
        for at in range(0, len(v), step):
            rows = _matrix(v.iloc[at : at + step], width).astype(np.float64)
            d2 = ((rows**2).sum(axis=1)[:, None] - 2 * rows @ centers.T + (centers**2).sum(axis=1)[None, :]).clip(0)
            cells.append(d2.argmin(axis=1).astype(np.int32))
            far.append(np.sqrt(d2[np.arange(len(rows)), cells[-1]]))
        return pd.DataFrame({"cell": np.concatenate(cells), "far": np.concatenate(far)})

    placed = stored(distinct.withColumn("at", nearest("v")).select("vec_id", "v", "at.cell", "at.far"))
    # A cell is cut into shells around its pivot, each with its own radius; only a shell of very many rows has several parts.
    blocks = F.ceil(F.count("*") / BLOCK_ROWS).cast("int")
    cells = placed.groupBy("cell").agg(
        F.least(blocks, F.lit(SHELLS)).alias("n"), blocks.alias("_blocks"),
        F.percentile_approx("far", [i / SHELLS for i in range(1, SHELLS)]).alias("q"),
    )
    cut = lambda i: F.get("q", F.floor(i * SHELLS / F.col("n")).cast("int") - 1)
    shells = cells.select(
        "cell", F.when(F.col("n") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.col("n") - 1, F.lit(1))), cut)).otherwise(F.array().cast("array<double>")).alias("cuts"),
        F.ceil(F.col("_blocks") / F.col("n")).cast("int").alias("parts"),
    )
    shells = stored(shells)
    data = stored(_with_blocks(placed, shells))
    # At most MAX_PIVOTS x SHELLS rows, however many blocks: the shells' radii and numbers of parts.
    place = F.split("block", ":")
    about = data.groupBy("cell", F.get(place, F.lit(1)).alias("shell")).agg(F.max("far").alias("r"), F.max(F.get(place, F.lit(2)).cast("int")).alias("last")).collect()
    rows = stored(queries.select("vec_id", "v").distinct().withColumn("at", nearest("v")).select("vec_id", "v", "at.cell", "at.far"))
    # Queries of one group are near each other, so that they share blocks and the trees prune.
    many = rows.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("_groups"))
    # Cells of few queries share a group, so that a block is copied to no more groups than the queries fill.
    shared_by = F.col("cell") % groups_for(rows.count(), QUERY_ROWS)
    asked = rows.join(F.broadcast(many), "cell").withColumn("group", F.concat_ws(":", shared_by, F.pmod(F.xxhash64("vec_id"), F.col("_groups")))).drop("_groups")

    def met(pairs: DataFrame) -> DataFrame:
        """The rows of each block that some query of a group has to meet, once a group."""
        wanted = pairs.select(F.col("block").alias("_b"), F.col("group").alias("_g")).distinct()
        return data.join(wanted, F.col("block") == F.col("_b")).select("vec_id", "v", "block", F.col("_g").alias("group"))

    first = stored(_with_blocks(asked, shells).select("vec_id", "v", "group", "block", F.lit(float("-inf")).alias("floor")))
    seeds = _best(_search(met(first), first, k), k).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    floors = asked.join(seeds, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).select("vec_id", "v", "group", "floor")

    named = [(f"{b['cell']}:{b['shell']}:", b["last"] + 1) for b in about]
    cell, r = np.asarray([b["cell"] for b in about], np.int64), np.asarray([b["r"] for b in about], np.float64)

    @F.pandas_udf("array<string>")
    def open_blocks(v: pd.Series, floor: pd.Series) -> pd.Series:
        width = max([len(c) for c in shared.value] + [len(x) for x in v])
        centers = np.stack([np.pad(c, (0, width - len(c))) for c in shared.value])
        length = np.sqrt((centers**2).sum(axis=1))
        out: list[list[str]] = []
        # The products with the pivots serve all their shells; a few queries at a time meet all shells.
        step = max(1, BOUND_CELLS // max(1, len(cell)))
        for at in range(0, len(v), step):
            rows = _matrix(v.iloc[at : at + step], width).astype(np.float64)
            norm = np.sqrt((rows**2).sum(axis=1))[:, None]
            bound = (rows @ centers.T)[:, cell] + norm * r[None, :]
            bound += 1e-9 * (np.abs(bound) + norm * (length[cell] + r)[None, :]) + 1e-6
            for mine, f in zip(bound, floor.iloc[at : at + step]):
                out.append([f"{named[j][0]}{part}" for j in np.flatnonzero(mine >= f) for part in range(named[j][1])])
        return pd.Series(out)

    pairs = stored(floors.withColumn("block", F.explode(open_blocks("v", "floor"))))
    return _best(_search(met(pairs), pairs, k), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every id divisible by 100 against all other rows."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), quantized(F.col("embedding")).alias("v"))
    rows = rows.filter("vec_id is not null and v is not null")
    return top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP4_SQL = """
WITH valid AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: TRY_CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND coalesce(list_sum(list_transform(embedding, lambda x: (1024 * x::DOUBLE) * (1024 * x::DOUBLE))), 0) < 4611686018427387904
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM valid q JOIN valid c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
