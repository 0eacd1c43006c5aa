import duckdb
import numpy as np
import pandas as pd
import pytest

from presswork.llm import mtree as mt


def brute(rows, is_query, k):
    """``rows`` are (id, vector) with unique ids; vectors are integers already."""
    out = []
    for i, v in rows:
        if is_query(i):
            others = sorted(((-int(v @ w), j) for j, w in rows if j != i))[:k]
            out += [(i, place, j, -s) for place, (s, j) in enumerate(others, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def as_tuples(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_same_as_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(mt, "PER_PIVOT", 60)
    monkeypatch.setattr(mt, "PER_TREE", 40)
    monkeypatch.setattr(mt, "PAGE", 8)
    monkeypatch.setattr(mt, "QUERIES_PER_BLOCK", 7)
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(6, 5))
    x = centers[rng.integers(6, size=500)] * rng.uniform(0.3, 2, (500, 1)) + rng.normal(size=(500, 5)) * spread
    x[100:220] = x[7]  # one vector of a quarter of all rows
    x[300:310] = 0
    x = np.round(x, 1)  # many ties
    out = mt.top_k(frame(spark, list(enumerate(x))), mt.F.col("vec_id") % 10 == 0, k=5)
    ints = [(i, np.floor(1024 * v).astype(int)) for i, v in enumerate(x)]
    assert as_tuples(out) == brute(ints, lambda i: i % 10 == 0, 5)


def test_tree_finds_all_and_saves_distances():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 16)) * 4000
    x = (centers[rng.integers(40, size=4000)] + rng.normal(size=(4000, 16)) * 60).astype(np.int64)
    space = mt.Space(int((x**2).sum(axis=1).max()), 16)
    pages = pd.DataFrame(
        {
            "page": i,
            "vectors": [x[j].astype(mt.PACKED).tobytes() for j in p["rows"]],
            "to_parent": p["to_parent"].tobytes(),
            "radius": p["radius"].tobytes() if "child" in p else None,
            "child": p["child"].tobytes() if "child" in p else None,
            "ids": None if "child" in p else [[int(j)] for j in p["rows"]],
        }
        for i, p in enumerate(mt.build_pages(x, space))
    )
    tree = mt.Tree(pages, space)
    for q in x[:50]:
        want = sorted(((int(q @ v), -i) for i, v in enumerate(x)), reverse=True)[:10]
        assert sorted(((s, -i) for s, i in tree.search(q, 10, None)), reverse=True) == want
        assert sorted(((s, -i) for s, i in tree.search(q, 10, want[-1][0])), reverse=True) == want
    assert tree.computed < 0.5 * 100 * len(x)


def test_covering_radii_and_parent_distances():
    x = np.random.default_rng(2).integers(-3000, 3000, (700, 4))
    space = mt.Space(int((x**2).sum(axis=1).max()), 4)
    pages, lifted, seen = mt.build_pages(x, space, 8), space.lifted(x), []

    def below(number):
        p = pages[number]
        return p["rows"].tolist() if "child" not in p else [r for c in p["child"] for r in below(c)]

    for p in pages:
        if "child" not in p:
            seen += p["rows"].tolist()
            continue
        for r, radius, child in zip(p["rows"], p["radius"], p["child"], strict=True):
            distance = np.linalg.norm(lifted[below(child)] - lifted[r], axis=1)
            assert distance.max() <= radius + 1e-3
            assert np.allclose(pages[child]["to_parent"], np.linalg.norm(lifted[pages[child]["rows"]] - lifted[r], axis=1), atol=1e-3)
    assert sorted(seen) == list(range(700))


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [nan, 1.0]), (4, [inf]), (5, []), (6, [3.0, 0.0, 0.0]), (None, [9.0])]
    df = frame(spark, rows).withColumns({"key": mt.F.lit(1), "score": mt.F.lit(2)})
    df = df.unionByName(spark.createDataFrame([(8, None)], "vec_id long, x long").selectExpr("vec_id", "array(cast(null as double)) as embedding", "1 as key", "2 as score"))
    got = as_tuples(mt.top_k(df, mt.F.lit(True), k=10))
    parts = {0: [1024, 2048, 0], 1: [1024, 0, 0], 5: [0, 0, 0], 6: [3072, 0, 0]}
    assert got == brute([(i, np.array(v)) for i, v in parts.items()], lambda i: True, 10)
    assert mt.top_k(df.limit(0), mt.F.lit(True)).count() == 0
    assert mt.top_k(df.filter("vec_id = 1"), mt.F.lit(True)).count() == 0


def test_long_vectors_take_part(spark):
    """A component of 200,000 is a candidate like any other; beyond 64 bits nothing is dropped in silence."""
    rows = [(100, [3.0, 1.0]), (1, [2.0, 0.5]), (2, [200_000.0, -7.0]), (3, [-1e5, 1e6])]
    ints = [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v in rows]
    assert as_tuples(mt.top_k(frame(spark, rows), mt.F.lit(True), k=3)) == brute(ints, lambda i: True, 3)
    with pytest.raises(Exception, match="64 bits"):
        mt.top_k(frame(spark, [*rows, (7, [1e30])]), mt.F.lit(True)).count()


def test_rows_that_share_an_id(spark, stored):
    """As the SQL has it: every row is a candidate for rows of other ids, and copies of a query share a list."""
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.integers(-3, 4, 3).astype(float)) for i in rng.choice([0, 100, 200, 1, 2, 3, 4, 5, 6], 120)]
    rows += [(100, np.array([1.0, 1.0, 1.0]))] * 25 + [(7, np.array([2.0, 2.0, 2.0]))] * 30
    folder = stored(embeddings=frame(spark, rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    want = sorted((q, r, i, s) for q, r, i, s in con.execute(mt.OP4_SQL).fetchall())
    assert as_tuples(mt.op4_mtree(spark, folder)) == want
