import numpy as np
import pytest

from presswork.llm import quality as q


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    out = q.op1_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    both = out.join(labels, "doc_id").toPandas()
    held = both[both["held_out"]]
    assert len(held) > 500 and out.count() == 10_000
    assert (held["quality"] == held["predicted"]).mean() > 0.97
    bad = held["quality"] == 0
    assert held[bad]["predicted"].mean() < 0.1 and held[~bad]["predicted"].mean() > 0.98


def two_kinds(rng, n):
    """Half of the positives are trusted; the prior is 0.7."""
    good = rng.random(n) < 0.7
    x = rng.normal(size=(n, q.N_FEATURES)).astype(np.float32)
    x[:, 0] += np.where(good, 1.5, -1.5)
    return x, good, good & (rng.random(n) < 0.5)


@pytest.fixture(scope="module")
def learned(spark):
    x, good, trusted = two_kinds(np.random.default_rng(4), 8000)
    rows = spark.createDataFrame([(v.tolist(), bool(t)) for v, t in zip(x, trusted, strict=True)], "x array<float>, positive boolean")
    return q.learn(rows.repartition(5).persist()), x, good, trusted


def test_prior_and_scores(learned):
    model, x, good, trusted = learned
    assert abs(model.prior - 0.7) < 0.1
    assert ((model.score(x) >= 0.5) == good).mean() > 0.9


def test_risk_falls_and_stays_non_negative(learned):
    model, x, _, trusted = learned
    assert all(b < a for a, b in zip(model.history, model.history[1:], strict=False)) and len(model.history) > 2
    g = model.design(x.astype(float)) @ model.weights
    loss = lambda z: np.logaddexp(0, -z)
    negative = loss(-g).mean() - model.prior * loss(-g[trusted]).mean()
    assert negative >= 0
    ridge = 0.5 * q.RIDGE * (model.weights[:-1] ** 2).sum()
    assert model.history[-1] == pytest.approx(model.prior * loss(g[trusted]).mean() + negative + ridge, rel=1e-6)


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "c " * 200_000), (3, "d"), (4, " \n ")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (2, 1), (2, 1)], "doc_id long, quality int")
    rows = q.with_vectors(docs, labels)
    found = {r["doc_id"]: r["positive"] for r in rows.collect()}
    assert rows.count() == 6 and found == {1: False, 2: True, None: False, 3: False, 4: False}
    nobody = q.learn(rows.filter("NOT positive").select("x", "positive"))
    assert {r["score"] for r in q.scored(rows.select("doc_id", "x"), nobody).collect()} == {0.5}
    model = q.learn(rows.select("x", "positive"))
    scores = [r["score"] for r in q.scored(rows.select("doc_id", "x"), model).collect()]
    assert all(0 <= s <= 1 for s in scores)
    empty = q.learn(rows.limit(0).select("x", "positive"))
    assert q.scored(rows.limit(0).select("doc_id", "x"), empty).count() == 0
