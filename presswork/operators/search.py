"""Queries over a vector collection.

A collection here is a flat frame: ``article_id``, ``vector`` and the payload
columns. Filters are applied before the ranking, which is a bounded top-k per
task followed by a merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.functions.binding import non_empty
from presswork.functions.frames import plain_text
from presswork.operators.collection import embed_hashed, norm
from presswork.schemas import VECTOR_SIZE

TARGETS_PER_BLOCK = 10_000
TARGETS_AT_ONCE = 256
TRACKED = 100_000  # entities that a sketch keeps apart


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; 0 for a zero vector."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0))


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def query_vector(spark: SparkSession, text: str, size: int = VECTOR_SIZE) -> Column:
    """Embedding of a query text as a one-value subquery."""
    return embed_hashed(spark.createDataFrame([(text,)], "text string"), "text", size).select("vector").scalar()


def matching(
    collection: DataFrame,
    category: str | None = None,
    country: str | Sequence[str] | None = None,
    sentiment: str | None = None,
) -> DataFrame:
    """Rows meeting all given conditions; None leaves a field free."""
    if category is not None:
        collection = collection.filter(F.col("category") == category)
    if isinstance(country, str):
        collection = collection.filter(F.col("source_country") == country)
    elif country is not None:
        collection = collection.filter(F.col("source_country").isin(*country))
    if sentiment is not None:
        collection = collection.filter(F.col("sentiment_label") == sentiment)
    return collection


def scored(collection: DataFrame, query: Column) -> DataFrame:
    posed = collection.withColumn("_query", query)
    score = cosine(F.col("vector"), F.col("_query"))
    return posed.withColumn("similarity_score", score).drop("vector", "_query")


def top(scored_rows: DataFrame, limit: int) -> DataFrame:
    """Best rows; equal scores go by article."""
    return scored_rows.orderBy(F.desc("similarity_score"), "article_id").limit(limit)


def hybrid_search(
    collection: DataFrame,
    query: Column,
    category: str | None = None,
    country: str | None = None,
    sentiment: str | None = None,
    limit: int = 5,
) -> DataFrame:
    return top(scored(matching(collection, category, country, sentiment), query), limit)


def advanced_search(
    collection: DataFrame, query: Column, filters: dict | None = None, limit: int = 10
) -> DataFrame:
    """Search with ``category, country, countries, sentiment`` and ``min_score``."""
    filters = filters or {}
    rows = matching(
        collection,
        filters.get("category"),
        filters.get("countries") or filters.get("country"),
        filters.get("sentiment"),
    )
    found = scored(rows, query)
    if filters.get("min_score") is not None:
        found = found.filter(F.col("similarity_score") >= filters["min_score"])
    return top(found, limit)


def browse(
    collection: DataFrame, category: str | None = None, country: str | None = None, limit: int = 10
) -> DataFrame:
    """Matching rows in key order, payload only."""
    rows = matching(collection, category, country).orderBy("article_id").limit(limit)
    payload = [c for c in rows.columns if c != "vector"]
    return rows.select(F.struct(*payload).alias("payload"))


def related(
    collection: DataFrame, article_id: str, limit: int = 3, category_bias: str | None = None
) -> DataFrame:
    """Articles nearest to one article, itself excluded.

    With a category only its articles are taken, unless there are none: then all
    are. Both tests are one-value subqueries of the same plan. An unknown
    article has no vector and so no neighbours.
    """
    target = (
        collection.filter(F.col("article_id") == article_id).select("vector").limit(1).scalar()
    )
    others = collection.filter(F.col("article_id") != article_id)
    candidates = others.withColumn("_target", target).filter(F.col("_target").isNotNull())
    if category_bias is not None:
        same = others.filter(F.col("category") == category_bias).limit(1)
        none_same = same.agg(F.count("*") == 0).scalar()
        candidates = candidates.filter((F.col("category") == category_bias) | none_same)
    ranked = candidates.withColumn("similarity_score", cosine(F.col("vector"), F.col("_target")))
    return top(ranked.drop("vector", "_target"), limit)


def related_batch(collection: DataFrame, targets: DataFrame, limit: int = 3) -> DataFrame:
    """``target_id, article_id, similarity_score, rank`` for any number of articles.

    ``targets`` (``article_id, vector``) is stored once and worked through in blocks
    of about ``TARGETS_PER_BLOCK``; a block travels with the tasks as one matrix.
    Every task keeps its best ``limit`` per target, so the shuffle carries
    candidates, not pairs.
    """
    stored = materialize(targets.select("article_id", "vector"), "targets")
    blocks = max(1, -(-stored.count() // TARGETS_PER_BLOCK))
    block = F.pmod(F.xxhash64("article_id"), F.lit(blocks))
    parts = []
    for i in range(blocks):
        # One block is in the driver at a time: its candidates are written before the next comes.
        found = _nearest(collection, stored.filter(block == i).collect(), limit)
        parts.append(found if blocks == 1 else materialize(found, "nearest"))
    partial = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("target_id").orderBy(F.desc("similarity_score"), "article_id")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def _nearest(collection: DataFrame, wanted: list, limit: int) -> DataFrame:
    """The best ``limit`` rows of every task for each target of one block."""
    ids = [r["article_id"] for r in wanted]
    vectors = np.array([r["vector"] for r in wanted], dtype=np.float64)
    key_type = collection.schema["article_id"].dataType.simpleString()

    def nearest(batches):
        import pandas as pd

        if not ids:
            return
        wanted_rows = vectors
        lengths = np.linalg.norm(wanted_rows, axis=1)
        place = {name: i for i, name in enumerate(ids)}
        found = None
        for batch in batches:
            if not len(batch):
                continue
            # In key order a stable sort by score breaks ties by key.
            batch = batch.sort_values("article_id")
            names = batch["article_id"].to_numpy()
            block = np.stack(batch["vector"].to_numpy()).astype(np.float64)
            norms = np.linalg.norm(block, axis=1)
            own = {place[n]: j for j, n in enumerate(names) if n in place}
            frames = [] if found is None else [found]
            for first in range(0, len(ids), TARGETS_AT_ONCE):
                some = slice(first, first + TARGETS_AT_ONCE)
                dots = wanted_rows[some] @ block.T
                scale = np.outer(lengths[some], norms)
                scores = np.divide(dots, scale, out=np.zeros_like(dots), where=scale > 0)
                for i, j in own.items():
                    if first <= i < first + len(scores):
                        scores[i - first, j] = -np.inf
                best = np.argsort(-scores, axis=1, kind="stable")[:, :limit]
                targets = np.repeat(np.arange(first, first + len(scores)), best.shape[1])
                frames.append(
                    pd.DataFrame(
                        {
                            "target": targets,
                            "name": names[best.ravel()],
                            "score": np.take_along_axis(scores, best, axis=1).ravel(),
                        }
                    )
                )
            found = (
                pd.concat(frames)
                .sort_values(["target", "score", "name"], ascending=[True, False, True])
                .groupby("target", sort=False)
                .head(limit)
            )
        if found is not None:
            found = found[found["score"] > -np.inf]
        if found is None or found.empty:
            return
        yield plain_text(
            pd.DataFrame(
                {
                    "target_id": [ids[int(t)] for t in found["target"]],
                    "article_id": found["name"].array,
                    "similarity_score": found["score"].to_numpy(dtype=float),
                }
            )
        )

    schema = f"target_id {key_type}, article_id {key_type}, similarity_score double"
    return collection.select("article_id", "vector").mapInPandas(nearest, schema)


def trending(collection: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent entities of all articles; equal counts go by name."""
    counts = collection.select(F.explode(non_empty(F.col("entities"))).alias("entity")).groupBy("entity").count()
    return counts.orderBy(F.desc("count"), "entity").limit(limit)


def entity_sketches(collection: DataFrame, *by: str, tracked: int = TRACKED) -> DataFrame:
    """A mergeable sketch of frequent entities for each group, or one of all: ``by, sketch``.

    Made per task and merged, in memory that does not grow with the articles. Counts are
    exact while a group has at most three quarters of ``tracked`` entities, beyond that
    the most frequent ones are kept with bounded errors.
    """
    mentions = collection.select(*by, F.explode(non_empty(F.col("entities"))).alias("entity"))
    return mentions.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate(entity, {tracked})").alias("sketch"))


def trending_of_sketches(sketches: DataFrame, limit: int = 10, tracked: int = TRACKED) -> DataFrame:
    """Most frequent entities of stored sketches, of one run or of several; equal counts go by name."""
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    found = merged.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {tracked})")))
    return found.select(F.col("item").alias("entity"), "count").orderBy(F.desc("count"), "entity").limit(limit)
