"""The neighbour graph and its search against comparing everything."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import neighbours as N
from textloom.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>"


def nearest(rows, k, asked):
    """``query_id: [(distance, vec_id)]`` by definition; null ids rank behind others."""
    good = [(i, v) for i, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    ids, vectors = [i for i, _ in good], np.array([v for _, v in good], np.float32).astype(float)
    rank = np.array([math.inf if i is None else i for i in ids])
    out = {}
    for q in [q for q, i in enumerate(ids) if i is not None and asked(i)]:
        dist = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        dist[q] = np.inf
        best = [j for j in np.lexsort((rank, dist)) if j != q][:k]
        out.setdefault(ids[q], []).append([(dist[j], ids[j]) for j in best])
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    return out


def recall(got, wanted):
    hits = [len({i for _, i, _ in got[q]} & {i for _, i in rows[0]}) / len(rows[0]) for q, rows in wanted.items()]
    return sum(hits) / len(hits)


def test_whole_table(spark):
    """The registered query over a whole table, with its production parameters."""
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = nearest(rows, 10, lambda i: i % 100 == 0)
    got = found(queries.QUERIES["op13_approximate_nearest_neighbours"](spark, sf_dir))
    assert got.keys() == wanted.keys() and all([r for _, _, r in g] == list(range(1, 11)) for g in got.values())
    assert recall(got, wanted) >= 0.97
    vectors = dict(rows)
    for q, near in got.items():
        for score, i, _ in near:
            gap = np.array(vectors[q], float) - np.array(vectors[i], float)
            assert score == pytest.approx(math.sqrt((gap * gap).sum()), rel=1e-14)


def test_evenly_spread_vectors(spark):
    """Blocks hold a small share of such vectors' neighbours: the rounds have to find them."""
    vectors = np.random.default_rng(4).normal(size=(4000, 32)).astype(np.float32)
    rows = list(enumerate(vectors.tolist()))
    wanted = nearest(rows, 10, lambda i: i % 100 == 0)
    got = found(N.nearest_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 100 == 0))
    assert recall(got, wanted) >= 0.95


def test_equal_vectors_ties_and_odd_rows(spark):
    draw = np.random.default_rng(2)
    same = [1.0, 0.0, 2.0]
    rows = [(i, same) for i in range(700, 0, -1)]  # a third of all rows share a vector
    rows += [(1000 + i, v) for i, v in enumerate(draw.normal(size=(60, 3)).astype(np.float32).tolist())]
    rows += [(2000 + i, [float(x), float(y), 5.0]) for i, (x, y) in enumerate((x, y) for x in range(5) for y in range(5))]  # ties
    rows += [(3000, None), (3001, []), (3002, [0.0, 0.0, 0.0]), (3003, [1.0, None, 1.0]), (3004, [1.0, math.nan, 1.0])]
    rows += [(3005, [math.inf, 1.0, 1.0]), (None, [1.0, 0.0, 2.5]), (None, same), (1000, [-1.0, 0.0, 2.0]), (3100, [1.0, -0.0, 2.0])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit(1), "rank": F.lit(2), "label": F.lit("x")})
    got = N.nearest_neighbours(frame, F.col("vec_id") % 50 == 0)
    wanted = nearest(rows, 10, lambda i: i % 50 == 0)
    have = sorted((r["query_id"], r["rank"], r["score"], -1 if r["vec_id"] is None else r["vec_id"]) for r in got.collect())
    want = sorted(
        (q, rank + 1, d, -1 if i is None else i) for q, lists in wanted.items() for near in lists for rank, (d, i) in enumerate(near)
    )
    assert [(q, r, i) for q, r, _, i in have] == [(q, r, i) for q, r, _, i in want]
    assert np.allclose([x[2] for x in have], [x[2] for x in want], rtol=1e-12)


def test_few_rows(spark):
    asked = F.lit(True)
    assert N.nearest_neighbours(spark.createDataFrame([], SCHEMA), asked).count() == 0
    assert N.nearest_neighbours(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA), asked).count() == 0
    assert N.nearest_neighbours(spark.createDataFrame([(1, [0.0]), (2, None)], SCHEMA), asked).count() == 0
    three = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [3.0, 0.0]), (4, [1.0, 2.0, 3.0])]  # the last is of another length
    got = [tuple(r) for r in N.nearest_neighbours(spark.createDataFrame(three, SCHEMA), asked).orderBy("query_id", "rank").collect()]
    assert [(q, r, i) for q, r, i, _ in got] == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]
    assert got[0][3] == math.sqrt(2)


def test_distances_do_not_depend_on_the_company():
    """A pair has one distance in every block: equal entries of two lists are one."""
    vectors = np.random.default_rng(1).normal(size=(50, 64))
    codes = [row.tobytes() for row in N._codes(vectors)]
    whole = N._Coded(codes)
    full = N._squares(whole.parts, whole.scale, whole.square)
    some = N._Coded([codes[i] for i in (7, 3, 41)])
    part = N._squares(some.parts, some.scale, some.square)
    assert part[0, 1] == part[1, 0] == full[7, 3] == full[3, 7] and part[2, 0] == full[41, 7]
    true = ((vectors[7] - vectors[3]) ** 2).sum()
    assert abs(math.sqrt(full[7, 3]) - math.sqrt(true)) < 0.02 * math.sqrt(true)
