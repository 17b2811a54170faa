"""Nearest neighbours against brute force, and the curve itself."""

import numpy as np

from tickweave.llm import curves

DDL = "vec_id long, embedding array<double>, label int"


def rows_of(seed=0, count=700, dims=12):
    rng = np.random.default_rng(seed)
    points = np.round(rng.normal(size=(count, dims)), 2)
    points[300:360] = points[7]             # many copies of one vector
    rows = [(i, points[i].tolist(), 0) for i in range(count)]
    bad = [(1000, None, 0), (1100, [0.0] * dims, 0), (1200, [float("nan")] * dims, 0),
           (1300, [None] + [1.0] * (dims - 1), 0), (1400, [1.0, 2.0], 0), (None, [1.0] * dims, 0),
           (1500, [float("inf")] + [1.0] * (dims - 1), 0), (1600, [], 0)]
    return rows + bad + rows[:3], points


def test_against_brute_force(spark):
    rows, points = rows_of()
    frame = spark.createDataFrame(rows, DDL)
    asked = frame.filter("vec_id % 100 = 0").selectExpr("vec_id as query_id")
    got = curves.nearest_neighbours(frame, asked, block=64).collect()
    queries = sorted({r["query_id"] for r in got})
    assert queries == [0, 100, 200, 300, 400, 500, 600]
    hits = 0
    for query in queries:
        own = sorted((r for r in got if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        far = np.sqrt(((points - points[query]) ** 2).sum(1))
        ids = np.array([i for i in range(len(points)) if i != query])
        true = ids[np.lexsort((ids, far[ids]))][:10]
        hits += len(set(true) & {r["vec_id"] for r in own})
        assert all(abs(r["score"] - far[r["vec_id"]]) < 1e-12 for r in own)
        assert [(r["score"], r["vec_id"]) for r in own] == sorted((r["score"], r["vec_id"]) for r in own)
    assert hits >= 0.9 * 10 * len(queries)
    copies = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 300]
    assert copies == [7, *range(301, 310)]  # ties to the smaller ids


def test_few_and_no_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)], DDL)
    asked = frame.selectExpr("vec_id as query_id")
    got = curves.nearest_neighbours(frame, asked).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 1), (1, 1, 0)]
    assert curves.nearest_neighbours(frame.limit(0), asked).count() == 0
    assert curves.nearest_neighbours(frame, asked.limit(0)).count() == 0


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = curves.hilbert_keys(cells, bits)
        assert len(set(keys.tolist())) == len(cells)
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
        assert steps.max() == 1
