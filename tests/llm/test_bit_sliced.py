import math
from fractions import Fraction

import duckdb
import numpy as np

from paperloom.llm import bit_sliced as B

SCHEMA = "vec_id long, embedding array<double>, label int, _v string"


def brute(rows, queries, k):
    out = []
    whole = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    q8 = lambda v: [math.floor(256 * Fraction(float(x))) for x in v]
    kept = [(i, q8(v)) for i, v in rows if whole(v)]
    for i, v in queries:
        if whole(v):
            scored = sorted((-sum(a * b for a, b in zip(q8(v), w, strict=False)), j) for j, w in kept if j != i)[:k]
            fits = lambda s: -(2**63) <= s < 2**63
            out += [(i, n, j, -s if fits(-s) else None, None if fits(-s) else str(-s)) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, queries, k=5, **more):
    df = lambda x: spark.createDataFrame([(i, v, 0, "x") for i, v in x], SCHEMA)
    return sorted(tuple(r) for r in B.top_k(df(rows), df(queries), k, **more).collect())


def test_equals_brute_force_with_ties_nulls_and_small_blocks(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)] + [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, [0.0] * 6)]
    queries = [r for r in rows if r[0] % 50 == 0] + [rows[3]]
    for more in ({}, {"block_rows": 64, "query_rows": 3}, {"block_rows": 500, "query_rows": 500}):
        assert run(spark, rows, queries, **more) == brute(rows, queries, 5)


def test_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, -1.0]), (50, [0.5, 0.5]), (7, [-1.0, 0.25])]
    assert run(spark, rows, rows[:2]) == brute(rows, rows[:2], 5)
    assert run(spark, [], []) == run(spark, rows, []) == []


def test_large_mixed_and_empty_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=4) * 10.0 ** int(rng.integers(-3, 12))]) for i in range(120)]
    rows += [(200, [1e30, -1e30, 0.25, 3.0]), (201, [1.7e308] * 4), (202, [-1.7e308, 1.0]), (203, []), (204, [1e30]), (205, [2e9, 2e9, 2e9, 2e9]), (206, [-0.0, 0.001]), (207, [0.0, 0.003]), (208, [5e-324])]
    queries = [r for r in rows if r[0] % 20 == 0 or r[0] >= 200]
    for more in ({}, {"block_rows": 50, "query_rows": 4}):
        assert run(spark, rows, queries, **more) == brute(rows, queries, 5)
    few = [r for r in rows if r[0] < 3 or r[0] == 205]
    assert run(spark, few, few) == brute(few, few, 5)
    empty = [(0, []), (50, []), (51, [])]
    assert run(spark, empty, empty[:2]) == brute(empty, empty[:2], 5) == [(0, 1, 50, 0, None), (0, 2, 51, 0, None), (50, 1, 0, 0, None), (50, 2, 51, 0, None)]


def test_sort_keys_rise_with_the_numbers():
    numbers = sorted({s * (2**e + d) for s in (1, -1) for e in (0, 7, 8, 15, 16, 63, 64, 700, 2100) for d in (-1, 0, 1)})
    keys = [B.sort_key(n) for n in numbers]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_signed_digits():
    for n in range(-300, 300):
        digits = B.signed_digits(n)
        assert sum(d << p if d > 0 else -(1 << p) for p, d in digits) == n
        assert all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:], strict=False))


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    assert sorted(tuple(r) for r in B.op7_bit_sliced_topk(spark, data).collect()) == sorted(con.execute(B.OP7_SQL).fetchall())
