import math

import numpy as np
import pytest

from quotewell.llm import neighbours
from quotewell.llm.neighbours import Graph, _unit, build_index, cosines, op11_neighbours, search

SF = "/root/testdata/sf0.01"


def exact(rows, queries, answers=5):
    """Every query against every row, in Python floats."""
    usable = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, v in queries:
        if q is None or not usable(v):
            continue
        norm = lambda u: math.sqrt(sum(x * x for x in u))
        best = {}
        for i, u in rows:
            if i != q and len(u) == len(v):
                best[i] = max(best.get(i, -2), sum(x * y for x, y in zip(u, v)) / (norm(u) * norm(v)))
        out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:answers]
    return out


def table(spark, rows):
    full = [(i, v, 1, "x", 2, [3], 0.5) for i, v in rows]
    return spark.createDataFrame(full, "vec_id bigint, embedding array<float>, shard int, node string, block int, ids array<int>, score double").repartition(3)


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = exact(rows, [x for x in rows if x[0] % 50 == 0])
    got = answers(op11_neighbours(spark, SF))
    assert got.keys() == want.keys() and all(len(got[q]) == 5 for q in want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    score = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(s - score[q, i]) < 1e-12 for q in got for i, s in got[q] if (q, i) in score)


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 30)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)).astype(np.float32))]
    queries = [x for x in rows if x[0] % 5 == 0]
    index = build_index(table(spark, rows), shard_rows=150)
    assert index.select("shard").distinct().count() == 4
    assert index.count() == 600
    got, want = answers(search(index, table(spark, queries))), exact(rows, queries)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.99


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [-0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [nan, 1.0]), (10, [inf, 1.0]),
            (None, [1.0, 0.0]), (11, [1.0, 1.0, 1.0]), (0, [1.0, 0.0]), (12, [3e38, 3e38]), (13, [1e-40, 1e-40])]
    got = answers(search(build_index(table(spark, rows)), table(spark, rows)))
    want = exact(rows, rows)
    assert got.keys() == want.keys() - {11}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got[q], want[q]))


def test_a_common_vector_does_not_hide_others(spark):
    """A third of all rows have one vector: ties go to the smallest ids, and other rows are found beside it."""
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 1.0, 0.0, 0.0]) if i % 3 == 0 else (i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 4)).astype(np.float32))]
    index = build_index(table(spark, rows))
    assert index.selectExpr("max(size(ids))").first()[0] == 6
    queries = [x for x in rows if x[0] % 50 == 0]
    got, want = answers(search(index, table(spark, queries))), exact(rows, queries)
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.97


def test_many_vectors_of_one_direction(spark):
    rng = np.random.default_rng(11)
    base = np.array([0.3, -0.7, 0.2])
    rows = [(i, (base * (1 + i)).tolist()) if i % 2 else (i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 3)).astype(np.float32))]
    queries = [x for x in rows if x[0] % 25 == 0]
    got, want = answers(search(build_index(table(spark, rows)), table(spark, queries))), exact(table(spark, rows).select("vec_id", "embedding").collect(), table(spark, queries).select("vec_id", "embedding").collect())
    for q in want:
        assert [round(s, 9) for _, s in got[q]] == [round(s, 9) for _, s in want[q]]


def test_empty_table(spark):
    index = build_index(table(spark, []))
    assert search(index, table(spark, [(0, [1.0])])).count() == 0
    some = build_index(table(spark, [(1, [1.0, 2.0])]))
    assert search(some, table(spark, [])).count() == 0
    assert search(some, table(spark, [(1, [1.0, 2.0])])).count() == 0


def test_pruning_keeps_diverse_edges_within_the_bound():
    rng = np.random.default_rng(8)
    unit = _unit(np.concatenate([rng.normal(size=(700, 6)), np.tile(rng.normal(size=6), (700, 1)) + rng.normal(size=(700, 6)) * 1e-4]))
    graph = Graph(unit).build()
    held = graph.edges >= 0
    assert held.any(1).all() and held.sum(1).max() <= neighbours.DEGREE
    for p in range(0, 1400, 97):
        own = graph.edges[p][held[p]]
        assert p not in own and len(set(own.tolist())) == len(own)
    reached, todo = set(graph.entries.tolist()), graph.entries.tolist()
    while todo:
        for k in graph.edges[todo.pop()]:
            if k >= 0 and int(k) not in reached:
                reached.add(int(k))
                todo.append(int(k))
    assert len(reached) == 1400


def test_equal_vectors_score_equally():
    v = np.random.default_rng(9).normal(size=(1, 64)).astype(np.float32)
    a, b = np.repeat(v, 33, 0), np.repeat(v * 2, 33, 0)
    assert len(set(cosines(a, b).tolist())) == 1
    assert cosines(v, v)[0] == pytest.approx(1.0, abs=1e-15)
