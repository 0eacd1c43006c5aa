"""Quality classifier learned from trusted positives and unlabelled text.

Positive-unlabelled learning with the non-negative risk: with the class prior p,

    risk(g) = p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)]),   l(z) = log(1 + exp(-z))

over trusted positives P and unlabelled texts U (all texts of the training folds; labels
of bad quality are never read). For this loss the unclipped risk is p * E_P[-g] +
E_U[log(1 + exp(g))], which is convex in a linear g: damped Newton steps minimise it, and a
step that would make the second term negative is not taken. The prior is estimated from
the data by the best bin (Garg et al., 2021) of a classifier of P against U.

Texts are read once, for a vector of shape statistics (shares of character classes, word
and line statistics, repetition). All learning is sums over these vectors, taken in the
tasks and added up in two levels; nothing is sampled.

Defined cases: null and empty texts have the same vector and a score like any other;
texts without a label are unlabelled, as are those whose labels disagree or are null; a
repeated row counts as often as it occurs; if there are no positives, scores are 0.5.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import fold, table

RIDGE = 1e-3
STEPS = 12
STEP_SIZES = (1.0, 0.5, 0.25, 0.1, 0.03)
BINS = 512
THRESHOLD = 0.3
SLOTS = 32

#: Characters whose share of a text is a feature, by group.
GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?",
    b";:", b"'\"", b"()[]{}", b"-_/\\", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"@^~=+`", bytes(range(128, 256)),
)
GROUP_OF = np.full(256, len(GROUPS))
for _i, _group in enumerate(GROUPS):
    GROUP_OF[list(_group)] = _i
N_FEATURES = len(GROUPS) + 1 + 10


def features(text: bytes) -> np.ndarray:
    """Shape statistics of one text, roots of shares unless said otherwise."""
    out = np.zeros(N_FEATURES)
    size = len(text)
    if not size:
        return out
    shares = np.bincount(GROUP_OF[np.frombuffer(text, np.uint8)], minlength=len(GROUPS) + 1) / size
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, m = len(words), len(lines)
    rest = np.zeros(10)
    rest[0] = np.log1p(size) / 10
    rest[1] = np.log1p(m) / 10
    if n:
        chars = sum(map(len, words))
        pairs = len(set(zip(words, words[1:], strict=False)))
        rest[2] = min(chars / n, 40) / 10
        rest[3] = len(set(words)) / n
        rest[4] = pairs / max(1, n - 1)
        rest[5] = np.sqrt(sum(map(operator.eq, words, words[1:])) / n)
        rest[6] = np.sqrt(sum(map(bytes.isupper, words)) / n)
        rest[7] = np.sqrt(sum(map(bytes.istitle, words)) / n)
        rest[8] = np.log1p(n / m) / 10
        rest[9] = 1 - len(set(lines)) / m
    out[: len(shares)] = np.sqrt(shares)
    out[len(shares) :] = rest
    return out


def feature_column(text: Column) -> Column:
    """Vector of ``features`` of a text column."""

    @F.arrow_udf("array<float>")
    def of(texts: pa.Array) -> pa.Array:
        rows = [features(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        flat = np.concatenate(rows).astype(np.float32) if rows else np.zeros(0, np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES), pa.array(flat))

    return of(text)


def vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def added(rows: DataFrame, sums: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """Sum over all tasks of what ``sums`` makes of a task's rows.

    The tasks' sums are added up in ``SLOTS`` tasks first, so the driver gets that many.
    """

    def row(slot: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "sums"])

    def first(batches):
        from pyspark import TaskContext

        yield row(TaskContext.get().partitionId() % SLOTS, sums(batches))

    def second(batches):
        totals = [np.frombuffer(x.as_py()) for b in batches for x in b.column(1)]
        if totals:
            yield row(0, np.sum(totals, axis=0))

    kind = "slot int, sums binary"
    parts = rows.mapInArrow(first, kind).repartition(SLOTS, "slot").mapInArrow(second, kind).collect()
    return np.sum([np.frombuffer(r["sums"]) for r in parts], axis=0) if parts else np.zeros(0)


@dataclass
class Model:
    """Linear score on standardised features; the last weight is the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float = 0.5
    history: list[float] = field(default_factory=list)

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -40, 40)))


def moments(rows: DataFrame) -> tuple[Model, float, float]:
    """Standardisation over unlabelled rows; numbers of unlabelled and of positive rows."""

    def sums(batches):
        total = np.zeros(2 + 2 * N_FEATURES)
        for batch in batches:
            x, positive = vectors(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            total += np.concatenate([[len(x), positive.sum()], x.sum(axis=0), (x**2).sum(axis=0)])
        return total

    total = added(rows, sums)
    n, positives = (float(x) for x in total[:2]) if len(total) else (0.0, 0.0)
    mean, square = (total[2:].reshape(2, -1) / max(n, 1)) if len(total) else np.zeros((2, N_FEATURES))
    scale = np.sqrt(np.maximum(square - mean**2, 0))
    scale[scale < 1e-6] = 1.0
    return Model(mean, scale, np.zeros(N_FEATURES + 1)), n, positives


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _at(rows: DataFrame, model: Model, candidates: np.ndarray, n: float, positives: float, known_p: bool) -> list[dict[str, np.ndarray]]:
    """Means over U and P that risks, gradients and Hessians are made of, at each candidate."""
    d, shared = N_FEATURES + 1, rows.sparkSession.sparkContext.broadcast((model, candidates))
    width = 4 + 3 * d + 2 * d * d

    def sums(batches):
        own, weights = shared.value
        total = np.zeros((len(weights), width))
        for batch in batches:
            x, positive = own.design(vectors(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
            xp = x[positive]
            for row, w in zip(total, weights, strict=True):
                g, gp = x @ w, xp @ w
                s = 1 / (1 + np.exp(-g))
                sp = 1 / (1 + np.exp(gp)) if known_p else np.zeros(len(gp))
                row[:4] += [_softplus(g).sum(), _softplus(-gp).sum(), _softplus(gp).sum(), gp.sum()]
                row[4 : 4 + 3 * d] += np.concatenate([s @ x, -(sp @ xp), xp.sum(axis=0)])
                row[4 + 3 * d :] += np.concatenate([((x * (s * (1 - s))[:, None]).T @ x).ravel(), ((xp * (sp * (1 - sp))[:, None]).T @ xp).ravel()])
        return total.ravel()

    out = []
    for row in added(rows, sums).reshape(len(candidates), width):
        gradients, hessians = row[4 : 4 + 3 * d].reshape(3, d), row[4 + 3 * d :].reshape(2, d, d)
        out.append(
            {
                "u": row[0] / n, "p": row[1] / positives, "p_as_negative": row[2] / positives, "gp": row[3] / positives,
                "du": gradients[0] / n, "dp": gradients[1] / positives, "mean_p": gradients[2] / positives,
                "hu": hessians[0] / n, "hp": hessians[1] / positives,
            }
        )
    return out


def newton(rows: DataFrame, model: Model, n: float, positives: float, prior: float | None, steps: int = STEPS) -> Model:
    """Minimise the non-negative risk, or with no prior the risk of P against U."""
    ridge = np.full(N_FEATURES + 1, RIDGE)
    ridge[-1] = 0.0

    def risk(m, w):
        if prior is None:
            value = m["p"] + m["u"]
        else:
            negative = m["u"] - prior * m["p_as_negative"]
            value = prior * m["p"] + negative if negative >= 0 else np.inf
        return value + 0.5 * ridge @ w**2

    def slope(m, w):
        if prior is None:
            return m["dp"] + m["du"] + ridge * w, m["hp"] + m["hu"] + np.diag(ridge + 1e-9)
        return m["du"] - prior * m["mean_p"] + ridge * w, m["hu"] + np.diag(ridge + 1e-9)

    w = model.weights
    here = _at(rows, model, w[None], n, positives, prior is None)[0]
    history = [risk(here, w)]
    for _ in range(steps):
        gradient, hessian = slope(here, w)
        direction = -np.linalg.solve(hessian, gradient)
        candidates = np.array([w + s * direction for s in STEP_SIZES])
        found = _at(rows, model, candidates, n, positives, prior is None)
        risks = [risk(m, c) for m, c in zip(found, candidates, strict=True)]
        best = int(np.argmin(risks))
        if not risks[best] < history[-1] - 1e-5:
            break
        w, here = candidates[best], found[best]
        history.append(risks[best])
    return Model(model.mean, model.scale, w, prior or 0.5, history)


def best_bin(rows: DataFrame, model: Model, n: float, positives: float) -> float:
    """Class prior: least share of U per share of P above a score, with its uncertainty."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def sums(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            positive = batch.column(1).to_numpy(zero_copy_only=False)
            place = np.minimum((shared.value.score(vectors(batch.column(0))) * BINS).astype(int), BINS - 1)
            total += [np.bincount(place, minlength=BINS), np.bincount(place[positive], minlength=BINS)]
        return total.ravel()

    counts = added(rows, sums).reshape(2, BINS)
    u, p = (np.cumsum(x[::-1]) / k for x, k in zip(counts, (n, positives), strict=True))
    slack = np.sqrt(np.log(40) / (2 * n)) + np.sqrt(np.log(40) / (2 * positives))
    some = p > 0
    bound = (u[some] + slack) / p[some]
    return float(np.clip((u[some] / p[some])[np.argmin(bound)], 0.01, 0.99))


def learn(rows: DataFrame) -> Model:
    """Model of stored training rows ``x, positive``; unlabelled are all of them."""
    model, n, positives = moments(rows)
    if not positives:
        return model
    against = newton(rows, model, n, positives, None)
    return newton(rows, model, n, positives, best_bin(rows, against, n, positives))


def scored(rows: DataFrame, model: Model, x: str = "x") -> DataFrame:
    """``rows`` with ``score`` instead of their vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(vectors(column)) if len(column) else np.zeros(0))

    return rows.withColumn("score", of(F.col(x))).drop(x)


def with_vectors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, x, positive``: a document is a trusted positive if all its labels say 1."""
    trusted = labels.groupBy("doc_id").agg((F.min(F.coalesce("quality", F.lit(0))) == 1).alias("positive"))
    return (
        docs.select("doc_id", feature_column(F.col("text")).alias("x"))
        .join(trusted, "doc_id", "left")
        .select("doc_id", "x", F.coalesce("positive", F.lit(False)).alias("positive"))
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    rows = materialize(with_vectors(table(spark, sf_dir, "documents"), labels), "vectors")
    model = learn(rows.filter(~held_out).select("x", "positive"))
    return scored(rows.select("doc_id", held_out.alias("held_out"), "x"), model).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


QUERIES = {"op1_quality": op1_quality}
ORACLES: dict[str, str] = {}
