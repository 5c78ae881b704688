import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, k=10):
    """Of (id, vector) rows without nulls: {query: [(vec_id, score)]}."""
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = {}
    for i, v in whole:
        if i % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_against_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "PART", 40)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[rng.integers(6)] + spread * rng.normal(size=16)).tolist()) for i in range(900)]
    rows += [(1000 + i, centres[0].tolist()) for i in range(300)]  # a vector shared by many
    assert found(topk.top_k(frame(spark, [(i, v, 0) for i, v in rows]))) == brute(rows)


def test_what_takes_no_part(spark):
    good = [(0, [1.0, 0.5]), (100, [-1.0, 2.0]), (3, [0.25, 0.25]), (4, [0.25, 0.25])]
    bad = [(5, None), (200, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [9.0, 9.0])]
    rows = frame(spark, [(i, v, 0) for i, v in good + bad]).withColumns({c: F.lit(1) for c in ("cell", "part", "v", "score")})
    assert found(topk.top_k(rows)) == brute(good)


def test_ids_that_repeat_and_short_vectors(spark):
    rows = frame(spark, [(0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0), (1, [1.0], 0), (1, [1.0], 0), (2, [], 0)])
    assert found(topk.top_k(rows)) == {0: [(1, 1048576), (1, 1048576), (2, 0)]}
    assert topk.top_k(frame(spark, [])).count() == 0
    assert topk.top_k(frame(spark, [(1, [1.0], 0)])).count() == 0


def test_a_repeated_query_row_gives_no_hit_twice(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 1)  # all rows lie in the part of the query
    rng = np.random.default_rng(12)
    rows = [(100, [1.0, 0.5, 0.25])] * 3 + [(i, rng.normal(size=3).tolist()) for i in range(1, 41)]
    assert found(topk.top_k(frame(spark, [(i, v, 0) for i, v in rows]))) == brute(rows)
    assert found(topk.top_k(frame(spark, [(i, v, 0) for i, v in rows + rows[:1]]), k=50)) == brute(rows, 50)


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(9)
    tree = topk.CoverTree(np.concatenate([c + 0.05 * rng.normal(size=(60, 8)) for c in 5 * rng.normal(size=(5, 8))]))
    assert any(n[4] for n in tree.nodes) and sorted(tree.order) == list(range(300))
    for start, end, centre, radius, children in tree.nodes:
        rows = tree.points[tree.order[start:end]]
        assert (np.linalg.norm(rows - centre, axis=1) <= radius + 1e-9).all()
        centres = [tree.nodes[c][2] for c in children]
        assert all(np.linalg.norm(a - b) > radius / 2 for i, a in enumerate(centres) for b in centres[:i])
        if children:
            assert [tree.nodes[c][0] for c in children] == [start, *(tree.nodes[c][1] for c in children[:-1])]


def test_far_nodes_are_skipped(monkeypatch):
    rng = np.random.default_rng(10)
    centres = 1000 * np.eye(20, dtype=int)  # every group's best partners are its own members
    data = np.concatenate([c + rng.integers(-2, 3, (64, 20)) for c in centres])
    seen = []
    monkeypatch.setattr(topk, "LEAF", 6)
    monkeypatch.setattr(topk.Search, "_leaves", lambda self, g, r, f=topk.Search._leaves: (seen.append(len(g) * len(r)), f(self, g, r)))
    topk.Search(data[::13], np.arange(0, len(data), 13), np.full(len(data[::13]), -(1 << 63)), data, np.arange(len(data)), 3).run()
    assert sum(seen) < 0.6 * len(data) * len(data[::13])
