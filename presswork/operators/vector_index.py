"""A collection stored for search: unit lengths known, near vectors in one folder.

Vectors are dealt to centres found on a bounded sample, and stored by filter column and
centre. A small table tells for every folder how many vectors it holds, the centre, and
the least cosine of any of them to it. By the triangle inequality of angles that bounds the
score of the folder's best vector, so a search opens only folders that can hold one of
the best rows; the result is that of a scan of everything. The length of each vector is
stored, so a row costs one dot product.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.collection import norm
from presswork.operators.search import matching, top
from presswork.sources.tables import overwrite_table, read_table

CENTRES = 64
SAMPLE = 50_000  # vectors that the centres are found on
SLACK = 1e-6  # of a bound, for the rounding of stored numbers


def dots(vector: Column, against: np.ndarray) -> Column:
    """Dot products of a vector with each row of a matrix, a batch of rows at a time."""
    size = against.shape[1]

    @F.arrow_udf("array<double>")
    def of(vectors: pa.Array) -> pa.Array:
        if vectors.null_count or any(n != size for n in set(vectors.value_lengths().to_pylist())):
            raise ValueError(f"vectors must have {size} components")
        block = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        # For one row the order of additions is fixed, so equal vectors have equal products.
        found = block @ against.T if len(against) > 1 else (block * against[0]).sum(axis=1)
        ends = np.arange(len(block) + 1, dtype=np.int32) * against.shape[0]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return of(vector)


def _centres(collection: DataFrame, count: int, seed: int) -> np.ndarray:
    """Unit centres of a sample of at most about ``SAMPLE`` vectors."""
    rows = collection.count()
    some = collection if rows <= SAMPLE else collection.sample(SAMPLE / rows, seed)
    units = some.select(F.transform("vector", lambda x: x / F.col("length")).alias("unit"), "length").filter("length > 0")
    points = units.select(array_to_vector("unit").alias("features"))
    size = collection.select(F.size("vector")).first()
    if size is None or points.isEmpty():
        return np.eye(1, size[0] if size else 1)
    model = KMeans(k=count, seed=seed, maxIter=10).fit(points)
    found = np.array(model.clusterCenters())
    lengths = np.linalg.norm(found, axis=1, keepdims=True)
    return np.divide(found, lengths, out=np.zeros_like(found), where=lengths > 0)


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Stored vectors, with the column types they were stored with."""
    return read_table(spark, f"{folder}/vectors", schema=read_table(spark, f"{folder}/columns").schema)


def build_index(
    collection: DataFrame, folder: str, by: Sequence[str] = ("category",), centres: int = CENTRES, seed: int = 1
) -> int:
    """Store a flat collection below ``folder``; the vectors stored.

    ``by`` are filter columns to keep apart. Centres only decide where a vector is kept.
    """
    measured = collection.withColumn("length", norm(F.col("vector")))
    matrix = _centres(measured, centres, seed)
    products = dots(F.col("vector"), matrix)
    nearest = measured.withColumn("_products", products).withColumn(
        "cluster", F.array_position("_products", F.array_max("_products")).cast("int") - 1
    )
    cosine = F.try_divide(F.element_at("_products", F.col("cluster") + 1), F.col("length"))
    placed = nearest.withColumn("to_centre", F.coalesce(cosine, F.lit(0.0))).drop("_products")
    rows = overwrite_table(placed, f"{folder}/vectors", [*by, "cluster"])
    overwrite_table(placed.limit(0), f"{folder}/columns")
    stored = _stored(collection.sparkSession, folder)
    known = F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in matrix]), F.col("cluster") + 1)
    summary = stored.groupBy(*by, "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("length") > 0, F.col("to_centre"))).alias("least"),
        F.count_if(F.col("length") == 0).alias("zeros"),
    )
    overwrite_table(summary.withColumn("centre", known), f"{folder}/folders")
    return rows


@dataclass(frozen=True)
class Index:
    """A stored collection, and what is known of its folders."""

    spark: SparkSession
    folder: str
    by: tuple[str, ...]
    folders: list

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Index:
        known = read_table(spark, f"{folder}/folders")
        by = tuple(c for c in known.columns if c not in ("cluster", "n", "least", "zeros", "centre"))
        return cls(spark, folder, by, known.collect())

    def rows(self, folders: Sequence) -> DataFrame:
        """Vectors of some folders; others are pruned from the scan."""
        stored = _stored(self.spark, self.folder)
        each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(f[c])) for c in (*self.by, "cluster")]) for f in folders]
        return stored.filter(reduce(or_, each, F.lit(False)))

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The highest cosine that a row of each folder can have."""
        length = np.linalg.norm(query)
        out = []
        for f in self.folders:
            best = -1.0 if f["least"] is None else 1.0
            if best > 0 and length > 0:
                to_centre = np.arccos(np.clip(np.dot(f["centre"], query) / length, -1, 1))
                best = np.cos(max(0.0, to_centre - np.arccos(np.clip(f["least"], -1, 1)))) + SLACK
            out.append(max(best, 0.0) if f["zeros"] or not length else best)
        return np.array(out)

    def search(
        self, query: Sequence[float], category: str | None = None, country: str | Sequence[str] | None = None,
        sentiment: str | None = None, min_score: float | None = None, limit: int = 10, without: str | None = None,
    ) -> DataFrame:
        """The ``limit`` rows with the highest cosine that meet the filters.

        The most promising folders are looked at first; then all are left out whose bound
        lies below the last of the best rows found there. ``without`` leaves out an article.
        """
        vector = np.asarray(query, np.float64)
        bounds = self.bounds(vector)
        usable = [i for i in np.argsort(-bounds, kind="stable").tolist() if category is None or self.folders[i].asDict().get("category", category) == category]
        first, seen = [], 0
        for i in usable:
            if seen >= 4 * limit and len(first) > 1:
                break
            first.append(i)
            seen += self.folders[i]["n"]

        def best(chosen: list[int]) -> DataFrame:
            rows = matching(self.rows([self.folders[i] for i in chosen]), category, country, sentiment)
            if without is not None:
                rows = rows.filter(F.col("article_id") != without)
            length = float(np.linalg.norm(vector))
            product = F.element_at(dots(F.col("vector"), vector[None]), 1)
            score = F.coalesce(F.try_divide(product, F.col("length") * F.lit(length)), F.lit(0.0))
            scored = rows.withColumn("similarity_score", score).drop("vector", "length", "cluster", "to_centre")
            if min_score is not None:
                scored = scored.filter(F.col("similarity_score") >= min_score)
            return top(scored, limit)

        if len(first) < len(usable):
            found = [r["similarity_score"] for r in best(first).select("similarity_score").collect()]
            last = min(found) if len(found) == limit else (-1.0 if min_score is None else min_score)
            first = [i for i in usable if bounds[i] >= last]
        return best(first)

    def related(self, article_id: str, limit: int = 3, category_bias: str | None = None) -> DataFrame:
        """Articles nearest to one, itself excluded; all categories where the given one has no other."""
        stored = _stored(self.spark, self.folder)
        own = stored.filter(F.col("article_id") == article_id).select("vector").first()
        if own is None:
            nothing = np.zeros(len(self.folders[0]["centre"]) if self.folders else 1)
            return self.search(nothing, limit=1).limit(0)
        others = stored.filter((F.col("article_id") != article_id) & (F.col("category") == category_bias)) if category_bias else None
        bias = category_bias if others is not None and not others.isEmpty() else None
        return self.search(own["vector"], category=bias, limit=limit, without=article_id)
