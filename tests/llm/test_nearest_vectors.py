import math

import numpy as np
import pytest

from cohortlens.llm import nearest_vectors as N
from cohortlens.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, queries, k):
    """(query, rank, id, distance) by all pairs; rows are unique (id, vector)."""
    out = []
    for q, v in sorted(queries):
        near = []
        for i, w in rows:
            if i != q and len(w) == len(v):
                total = 0.0
                for a, b in zip(v, w):
                    total += (a - b) * (a - b)
                near.append((math.sqrt(total), i))
        out += [(q, rank, i, s) for rank, (s, i) in enumerate(sorted(near)[:k], 1)]
    return out


def run(df, queries, **options):
    return sorted(tuple(r) for r in N.nearest(df, queries, **options).collect())


@pytest.mark.parametrize("spread", [1.0, 1e-9, 1e9])
def test_as_brute_force_with_ties_and_many_cells(spark, spread):
    rng = np.random.default_rng(5)
    base = rng.normal(0, spread, (300, 7)) + rng.normal(0, 3, 7)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # one vector many rows hold
    rows += [(2000 + i, np.round(v).tolist()) for i, v in enumerate(base[:80] / spread)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, SCHEMA)
    for values in (N.CELL_VALUES, 280):
        assert run(df, df.where("vec_id % 20 = 0"), cell_values=values) == brute(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    rows, queries = rng.normal(0, 1, (500, 64)), rng.normal(0, 1, (40, 64))
    rows[::50] *= 1e-6
    rows[1] = queries[0]
    lower, upper = N.bounds(N.Codes(rows), slice(0, 500), N.Codes(queries), slice(0, 40))
    true = np.sqrt(((queries[:, None] - rows[None]) ** 2).sum(axis=2))
    assert (lower <= true).all() and (true <= upper).all()
    assert (lower > np.partition(upper, 9, axis=1)[:, 9:10]).mean() > 0.9  # most pairs are never recomputed


def test_wide_vectors_have_exact_products():
    codes = N.Codes(np.full((2, 3000), 5.0))
    assert (codes.tile(0, 2) @ codes.tile(0, 2).T).tolist() == [[127 * 127 * 3000.0] * 2] * 2


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, []), (None, [1.0, 0.1]), (7, [1.0, 2.0]),
            (100, [3.0]), (200, [1.0, 1.0]), (200, [1.0, 1.0]), (300, [4.0, 4.0]), (300, [2.0, 9.0]), (400, [-0.0, 1e200]), (500, [0.0, -1e200])]
    df = spark.createDataFrame(rows, SCHEMA)
    good = [(0, [1.0, 0.0]), (7, [1.0, 2.0]), (100, [3.0]), (200, [1.0, 1.0]), (300, [2.0, 9.0]), (400, [0.0, 1e200]), (500, [0.0, -1e200])]
    assert run(df, df.where("vec_id % 100 = 0")) == brute(good, [g for g in good if g[0] % 100 == 0], 10)


def test_extreme_components(spark):
    rows = [(i, v) for i, v in enumerate([[1e308, 1.0], [-1e308, 1.0], [5e-324, 0.0], [1.0, 1.0], [1e308, 2.0]])]
    got = {(q, i): s for q, _, i, s in run(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA))}
    assert len(got) == 20 and got[0, 1] == float("inf") and got[0, 4] == 1.0 and got[2, 3] == math.sqrt(2)


def test_empty_tables_other_columns_and_float_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], "x", 3), (1, [1.5, 2.0], "y", 4)], "vec_id long, embedding array<float>, id string, rank int")
    assert run(df, df) == [(0, 1, 1, 0.5), (1, 1, 0, 0.5)]
    assert run(df, df.limit(0)) == [] and run(df.limit(0), df) == [] and run(df.limit(0), df.limit(0)) == []


def test_query_against_its_sql(spark):
    from oracle_compare import compare, duck

    out = QUERIES["op13_nearest_vectors"](spark, "/root/testdata/sf0.001")
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    con = duck("/root/testdata/sf0.001")
    ok, message = compare(out, con, ORACLES["op13_nearest_vectors"])
    assert ok, message
    assert sorted(tuple(r) for r in out.collect()) == sorted(con.execute(ORACLES["op13_nearest_vectors"]).fetchall())  # to the last bit
