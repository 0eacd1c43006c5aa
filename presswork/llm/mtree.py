"""Exact top-k search by inner product with M-trees.

Vectors become integers, floor(1024 x). With M the largest norm, (x, sqrt(M^2 - |x|^2))
for stored vectors and (q, 0) for queries turns the inner product into a distance,
d^2 = |q|^2 + M^2 - 2 q.x, so the highest products are the nearest neighbours in a metric
space. An M-tree holds its vectors in pages: each entry has a routing vector, a covering
radius and the distance to its parent's routing vector. Best-first search takes pages by
their least possible distance and skips entries by the triangle inequality on stored
distances before any distance is computed; it stops when no page can hold a better row.
Products are compared as integers, so results and ties are exact.

Scale: the vectors are dealt to pivots (a sample of at most ``MAX_PIVOTS``, which are
broadcast) and, within a pivot, to slices of a few thousand by hash; each slice is one
tree, written once as a table of pages. A query first visits the tree of its own place,
which bounds its k-th best product; then only the trees of pivots whose ball can hold
better. Queries go in blocks, so neither trees nor queries of one group are unbounded.
Equal vectors are one entry with the k + 1 least ids, and equal queries one search, which
looks for k rows more than there are of the query's own id.

Defined cases: rows with a null id or vector, or a null or non-finite component, take no
part; of vectors of different length the shorter counts as filled up with 0; rows that
share an id are candidates one by one, for rows of other ids, and as queries share
one list; a vector so long that a product might not fit 64 bits is an error; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import table

SCALE = 1024
PACKED = "<i8"
LARGEST = 1 << 62  # squared length; products of shorter vectors are exact in 64 bits
K = 10
MAX_PIVOTS = 1024
PER_PIVOT = 4096  # vectors per pivot, on average, until there are MAX_PIVOTS of them
PER_TREE = 4096
PAGE = 64
QUERIES_PER_BLOCK = 1000
SLACK = 1e-7  # of the largest lengths, for rounding in distances


def integers(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, key, v, norm`` of the rows that take part; ``v`` is packed 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, packed, norms = [], [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    continue
                with np.errstate(over="ignore"):
                    v = np.floor(SCALE * v)
                    if (v**2).sum() >= LARGEST:
                        raise ValueError(f"products of vector {i} may not fit 64 bits")
                v = np.trim_zeros(v.astype(PACKED), "b")
                ids.append(i), packed.append(v.tobytes()), keys.append(hashlib.md5(v.tobytes()).digest())
                norms.append(int((v**2).sum()))
            columns = [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary()), pa.array(norms, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "key", "v", "norm"])

    chosen = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    return chosen.mapInArrow(run, "vec_id long, key binary, v binary, norm long")


def matrix(packed, width: int) -> np.ndarray:
    """Rows of packed integers, filled up with zeros."""
    out = np.zeros((len(packed), width), np.int64)
    for row, x in zip(out, packed, strict=True):
        v = np.frombuffer(x, PACKED)
        row[: len(v)] = v
    return out


class Space:
    """The metric space: the largest squared norm and the width of all vectors."""

    def __init__(self, largest: int, width: int):
        self.largest, self.width = largest, width

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.largest - (vectors**2).sum(axis=1), 0))
        return np.hstack([vectors.astype(np.float64), extra[:, None]])

    def slack(self, q_norm):
        return SLACK * (1.0 + np.sqrt(q_norm + self.largest))

    def from_product(self, q_norm: float, product):
        """Distance between a query and a stored vector of this inner product."""
        return np.sqrt(np.maximum(q_norm + self.largest - 2.0 * np.asarray(product, np.float64), 0.0))


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of two lifted matrices."""
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def build_pages(vectors: np.ndarray, space: Space, page: int = PAGE) -> list[dict]:
    """Pages of one tree over at least one row; the first is the root.

    A page has ``rows`` (of ``vectors``: routing or stored ones), ``to_parent`` (distances
    to the routing vector that leads here), and, unless it is a leaf, ``radius`` and
    ``child`` (number of a page) per entry.
    """
    lifted, pages = space.lifted(vectors), []
    todo = [(np.arange(len(vectors)), None, None)]
    while todo:
        rows, parent, entry = todo.pop()
        number = len(pages)
        if entry is not None:
            pages[entry[0]]["child"][entry[1]] = number
        if len(rows) > page:
            # Routing vectors from all over the rows, then each row to the nearest.
            routing = rows[np.linspace(0, len(rows) - 1, min(page, -(-len(rows) // page) + 1)).astype(int)]
            distance = _between(lifted[rows], lifted[routing])
            nearest = distance.argmin(axis=1)
            used, nearest = np.unique(nearest, return_inverse=True)
            routing, distance = routing[used], distance[:, used]
            radius = np.zeros(len(routing))
            np.maximum.at(radius, nearest, distance[np.arange(len(rows)), nearest])
            if len(routing) > 1:
                for i in range(len(routing)):
                    todo.append((rows[nearest == i], routing[i], (number, i)))
                here, extra = routing, {"radius": radius, "child": np.zeros(len(routing), np.int64)}
            else:
                here, extra = rows, {}
        else:
            here, extra = rows, {}
        to_parent = np.zeros(len(here)) if parent is None else _between(lifted[here], lifted[[parent]])[:, 0]
        pages.append({"rows": here, "to_parent": to_parent, **extra})
    return pages


class Tree:
    """Pages of one tree, ready for searches."""

    def __init__(self, pages: pd.DataFrame, space: Space):
        self.space, self.pages = space, {}
        for p in pages.itertuples(index=False):
            leaf = p.radius is None
            self.pages[p.page] = (
                leaf,
                matrix(p.vectors, space.width),
                np.frombuffer(p.to_parent),
                np.zeros(len(p.vectors)) if leaf else np.frombuffer(p.radius),
                p.ids if leaf else np.frombuffer(p.child, np.int64),
            )
        self.computed = 0  # distances, to see what the bounds save

    def search(self, q: np.ndarray, k: int, bound: int | None) -> list[tuple[int, int]]:
        """The ``k`` best ``(product, id)`` rows, ties to the least id; those under ``bound`` may be missing."""
        space, norm = self.space, float((q.astype(np.float64) ** 2).sum())
        best: list[tuple[int, int]] = []  # heap of (product, -id)
        floor, slack = bound, float(space.slack(norm))
        reach = np.inf if floor is None else float(space.from_product(norm, floor)) + slack
        todo = [(0.0, 0, None)] if self.pages else []
        while todo:
            least, number, from_parent = heapq.heappop(todo)
            if least > reach:
                break
            leaf, vectors, to_parent, radius, below = self.pages[number]
            if from_parent is None:
                open_ = np.arange(len(vectors))
            else:
                open_ = np.flatnonzero(np.abs(from_parent - to_parent) - radius <= reach)
                if not len(open_):
                    continue
            self.computed += len(open_)
            products = vectors[open_] @ q
            if not leaf:
                distance = space.from_product(norm, products)
                nearest = np.maximum(distance - radius[open_], 0.0)
                for i in np.flatnonzero(nearest <= reach):
                    heapq.heappush(todo, (float(nearest[i]), int(below[open_[i]]), float(distance[i])))
                continue
            if floor is not None:
                fits = products >= floor
                open_, products = open_[fits], products[fits]
            for i, product in zip(open_.tolist(), products.tolist(), strict=True):
                for vec_id in below[i]:
                    row = (product, -int(vec_id))
                    if len(best) < k:
                        heapq.heappush(best, row)
                    elif row > best[0]:
                        heapq.heapreplace(best, row)
                    else:
                        break
            if len(best) == k and (floor is None or best[0][0] > floor):
                floor = best[0][0]
                reach = float(space.from_product(norm, floor)) + slack
        return [(product, -i) for product, i in best]


PAGES = "tree int, page long, vectors array<binary>, to_parent binary, radius binary, child binary, ids array<array<bigint>>"


def tree_pages(placed: DataFrame, space: Space) -> DataFrame:
    """Page tables of all trees of ``tree, v, ids`` rows."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v", ignore_index=True)
        packed, ids = rows["v"].to_numpy(), rows["ids"].to_numpy()
        out = []
        for number, p in enumerate(build_pages(matrix(packed, space.width), space)):
            inner = "child" in p
            out.append(
                {
                    "tree": int(rows["tree"].iloc[0]),
                    "page": number,
                    "vectors": [packed[i] for i in p["rows"]],
                    "to_parent": p["to_parent"].tobytes(),
                    "radius": p["radius"].tobytes() if inner else None,
                    "child": p["child"].tobytes() if inner else None,
                    "ids": None if inner else [list(ids[i]) for i in p["rows"]],
                }
            )
        return pd.DataFrame(out)

    return placed.groupBy("tree").applyInPandas(build, PAGES)


def visits(queries: DataFrame, pages: DataFrame, space: Space, blocks: int) -> DataFrame:
    """``key, vec_id, score`` rows of every ``tree, key, v, need, bound`` visit; ``need`` at most."""

    def search(asked: pd.DataFrame, pages_: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(asked) and len(pages_):
            tree = Tree(pages_, space)
            for key, v, need, bound in zip(asked["key"], matrix(asked["v"], space.width), asked["need"], asked["bound"], strict=True):
                found = tree.search(v, int(need), int(bound) if bound else None)
                rows += [(key, vec_id, product) for product, vec_id in found]
        return pd.DataFrame(rows, columns=["key", "vec_id", "score"])

    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    left = queries.withColumn("block", block).select("tree", "block", "key", "v", "need", F.col("bound").cast("string").alias("bound"))
    right = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = left.groupBy("tree", "block").cogroup(right.groupBy("tree", "block"))
    return both.applyInPandas(search, "key binary, vec_id long, score long")


def best_rows(rows: DataFrame, by: str, k: int, first: Column) -> DataFrame:
    """The first ``k`` rows of each ``by``; limited in each task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(first, F.col("vec_id")))
    return rows.withColumn("_place", place).filter(F.col("_place") <= k)


def top_k(rows: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` other rows of highest product for each query row.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = rows.sparkSession
    # Rows of equal id and vector: more than k of them are never needed.
    same = integers(rows, vec_id, embedding).groupBy("vec_id", "key")
    same = same.agg(F.first("v").alias("v"), F.first("norm").alias("norm"), F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    stored = materialize(same, "integers")
    size = stored.agg(F.max("norm").alias("norm"), F.max(F.length("v")).alias("bytes")).first()
    space = Space(size["norm"] or 0, max(1, (size["bytes"] or 0) // np.dtype(PACKED).itemsize))
    # Equal vectors: one entry with the k + 1 least ids, of which one may be the query's own.
    few = best_rows(stored, "key", k + 1, F.lit(0))
    ids = F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("times")))))
    entries = materialize(few.groupBy("key").agg(F.first("v").alias("v"), ids.alias("ids")), "entries")
    n = entries.count()
    queries = stored.filter(is_query)
    own = queries.groupBy("vec_id").agg(F.sum("times").alias("own"))
    need = queries.join(own, "vec_id").groupBy("key").agg((F.max("own") + k).alias("need"))
    asked = queries.select(F.col("vec_id").alias("query_id"), "key", F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
    searches = materialize(need.join(entries.select("key", "v"), "key"), "searches")
    blocks = max(1, -(-searches.count() // QUERIES_PER_BLOCK))
    wanted = max(1, min(MAX_PIVOTS, -(-n // PER_PIVOT)))
    sample = entries.select("v").orderBy(F.xxhash64("key")).limit(wanted).collect()
    pivots = space.lifted(matrix([bytes(r["v"]) for r in sample], space.width)) if sample else np.zeros((1, space.width + 1))
    deal = spark.sparkContext.broadcast((space, pivots))

    @F.arrow_udf("struct<pivot:int,distance:double>")
    def nearest(packed: pa.Array) -> pa.Array:
        space, pivots = deal.value
        distance = _between(space.lifted(matrix([x.as_py() for x in packed], space.width)), pivots)
        pivot = distance.argmin(axis=1) if len(distance) else np.zeros(0, np.int64)
        own = distance[np.arange(len(distance)), pivot]
        return pa.StructArray.from_arrays([pa.array(pivot.astype(np.int32)), pa.array(own)], names=["pivot", "distance"])

    dealt = materialize(entries.withColumn("p", nearest("v")).select("key", "v", "ids", "p.pivot", "p.distance"), "dealt")
    groups = {r["pivot"]: (r["n"], r["far"]) for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")).collect()}
    # Trees of a pivot are numbered one after another; a vector's hash chooses its tree.
    slices = [-(-groups.get(p, (0, 0))[0] // PER_TREE) for p in range(len(pivots))]
    first = np.append(0, np.cumsum(slices))
    radius = np.array([groups.get(p, (0, -np.inf))[1] for p in range(len(pivots))])
    at = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("pivot") + 1)
    tree = (at(first[:-1]) + F.pmod(F.xxhash64("key"), at(np.maximum(slices, 1)))).cast("int")
    dealt = dealt.withColumn("tree", tree)
    pages = materialize(tree_pages(dealt.select("tree", "v", "ids"), space), "pages")
    # The own tree first: it bounds the search.
    home = searches.join(dealt.select("key", "tree"), "key").withColumn("bound", F.lit(None).cast("long"))
    home = materialize(home.select("key", "v", "need", "tree", "bound"), "home")
    near = materialize(visits(home, pages, space, blocks), "found")
    bounds = near.groupBy("key").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n"))
    bounded = home.drop("bound").join(bounds, "key", "left").select("key", "v", "need", "tree", F.when(F.col("n") >= F.col("need"), F.col("bound")).alias("bound"))
    reach = spark.sparkContext.broadcast((space, pivots, radius, first))

    @F.arrow_udf("array<int>")
    def others(packed: pa.Array, own: pa.Array, bound: pa.Array) -> pa.Array:
        space, pivots, radius, first = reach.value
        q = matrix([x.as_py() for x in packed], space.width)
        norm = (q.astype(np.float64) ** 2).sum(axis=1)
        distance = _between(np.hstack([q, np.zeros((len(q), 1))]).astype(np.float64), pivots)
        out = []
        for d, n_, tree_, b in zip(distance, norm, own.to_pylist(), bound.to_pylist(), strict=True):
            limit = np.inf if b is None else float(space.from_product(n_, b) + 2 * space.slack(n_))
            open_ = np.flatnonzero((d - radius <= limit) & (np.diff(first) > 0))
            out.append([t for p in open_ for t in range(first[p], first[p + 1]) if t != tree_])
        return pa.array(out, pa.list_(pa.int32()))

    rest = bounded.withColumn("tree", F.explode(others("v", "tree", "bound")))
    far = visits(rest, pages, space, blocks)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    found = near.unionByName(far).withColumn("_place", place).join(need, "key").filter(F.col("_place") <= F.col("need")).drop("_place", "need")
    # Every query row gets its search's rows but those of its id, and k of them.
    mine = asked.join(found, "key").filter(F.col("vec_id") != F.col("query_id"))
    return best_rows(mine, "query_id", k, F.desc("score")).select("query_id", F.col("_place").cast("int").alias("rank"), "vec_id", "score")


def op4_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP4_SQL = f"""
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {K}
"""

QUERIES = {"op4_mtree": op4_mtree}
ORACLES = {"op4_mtree": OP4_SQL}
