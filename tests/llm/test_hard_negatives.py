import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from paperloom.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, _label string, _v string"


def brute(rows, anchors, positives=5, negatives=5, low_pct=80, high_pct=100):
    whole = lambda r: r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    cells = lambda v: [math.floor(256 * Fraction(float(x))) for x in v]
    kept = [(i, cells(v), y) for i, v, y in filter(whole, rows)]
    fits = lambda s: s if -(2**63) <= s < 2**63 else None
    out = []
    for i, q, y in {(i, tuple(cells(v)), y) for i, v, y in filter(whole, anchors)}:
        scored = sorted((-sum(a * b for a, b in zip(q, w, strict=False)), j, z) for j, w, z in kept if j != i)
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            near = [(n, j) for n, j, z in scored if z != y and low_pct * -s <= 100 * -n <= high_pct * -s][:negatives]
            out += [(i, p, k, j, fits(-s), fits(-n)) for k, (n, j) in enumerate(near, 1)]
    return sorted(out, key=str)


def run(spark, rows, anchors, **more):
    df = lambda x: spark.createDataFrame([(*r, "a", "b") for r in x], SCHEMA)
    return sorted((tuple(r) for r in H.hard_negatives(df(rows), df(anchors), **more).collect()), key=str)


def made(n=400, dims=6, labels=3, seed=4):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(rng.normal(size=dims))], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"block_rows": 37, "anchor_rows": 3}, {"positives": 2, "negatives": 9, "low_pct": 30, "high_pct": 140}])
def test_equals_brute_force(spark, more):
    rows = made()
    rows += [(900, None, 1), (901, [None] * 6, 1), (902, [float("nan")] * 6, 0), (903, rows[1][1], None), (None, rows[1][1], 1), (904, [], 2), (905, rows[2][1][:2], 0)]
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(12)] + [rows[11]] * 3
    anchors = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(3, rows[50][1], 1), rows[11], (77, rows[0][1], 55)]
    params = {k: v for k, v in more.items() if not k.endswith("_rows")}
    assert run(spark, rows, anchors, **more) == brute(rows, anchors, **params)


def test_values_of_any_size(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(size=3) * 10.0 ** int(rng.integers(-2, 11))], int(i % 2)) for i in range(60)]
    rows += [(100, [1e30, -1e30, 3.0], 0), (101, [1e30, -1e29, 0.0], 1), (102, [1.1e30, -1e30, 0.0], 0), (103, [5e-324, 0.0, 0.0], 1)]
    assert run(spark, rows, rows[::9] + rows[60:]) == brute(rows, rows[::9] + rows[60:])


def test_windows_of_ties_and_limits(spark):
    rows = [(0, [1.0], 0), (1, [1.0], 0), (2, [1.0], 1), (3, [0.8], 1), (4, [0.796], 1), (5, [1.004], 1), (6, [0.9], 1), (7, [-1.0], 1)]
    got = run(spark, rows, rows[:1])
    assert got == brute(rows, rows[:1]) and [r[3] for r in got] == [2, 6]
    negative = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.9], 1), (3, [-1.1], 1)]
    assert run(spark, negative, negative[:1]) == []


def test_empty_tables(spark):
    rows = made(30)
    assert run(spark, [], []) == run(spark, rows, []) == run(spark, [], rows) == run(spark, [(i, v, 1) for i, v, _ in rows], rows[:3]) == []


def test_candidates_leave_as_planes_come():
    rng = np.random.default_rng(1)
    cells = rng.integers(-128, 128, (5000, 70))
    block = H.Block(np.arange(5000), np.zeros(5000, np.int64), cells)
    query = rng.integers(-128, 128, 70)
    scores = cells @ query
    most = int(np.sort(scores)[-50])
    least = most - 2000
    got = block.best(query, np.arange(5000), [(least, most), (None, None)], 5)
    first = lambda fits: sorted(((int(scores[i]), int(i)) for i in np.flatnonzero(fits)), key=lambda r: (-r[0], r[1]))[:5]
    assert got == [first((scores >= least) & (scores <= most)), first(scores == scores)]
    seen = []
    planes = block.planes
    block.planes = type("Counting", (), {"__getitem__": lambda self, i: type("Plane", (), {"__getitem__": lambda _, at: seen.append(len(at)) or planes[i][at]})()})()
    block.best(query, np.arange(5000), [(None, None)], 5)
    assert seen[0] == 5000 and seen[-1] < 100 and seen == sorted(seen, reverse=True)


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    got = sorted(tuple(r) for r in H.op13_hard_negatives(spark, data).collect())
    assert got and got == sorted(con.execute(H.OP13_SQL).fetchall())
