import pytest
import numpy as np

from playlens.llm import topk


def slow(rows, queries, k=5):
    out = []
    for q in queries:
        s = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in rows if i != q[0])[:k]
        out += [(q[0], r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, frame, k=5):
    v = topk.quantised(frame)
    return sorted(tuple(r) for r in topk.top_k(v, v.where("id % 50 = 0"), k).collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id string")


def ints(rows):
    return [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in rows]


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16), monkeypatch.setattr(topk, "BLOCKS", 3), monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(5)
    rows = [(i * 7 - 900, (rng.normal(size=6) * rng.choice([0.1, 1, 30])).tolist()) for i in range(400)]
    rows += [(10_000 + i, rows[3][1]) for i in range(40)]  # ties
    want = ints(rows)
    assert run(spark, vectors(spark, rows)) == slow(want, [r for r in want if r[0] % 50 == 0])


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [0.5, 0.5]), (50, [-0.001, 2.0]), (6, []), (5, [0.5, 0.5])]
    fine = ints([r for r in rows if r[0] in (0, 5, 50, 6)])
    assert run(spark, vectors(spark, rows)) == slow(fine, [r for r in fine if r[0] % 50 == 0])


def test_no_rows(spark):
    assert run(spark, vectors(spark, [])) == []
    assert run(spark, vectors(spark, [(0, [1.0])])) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1 / 256]), (2, [3e6, 2 / 256])]
    want = ints(rows)
    assert run(spark, vectors(spark, rows)) == slow(want, want[:1])


def test_blocks_below_the_kth_score_are_skipped():
    near, far = np.full((64, 4), 1000), np.full((64, 4), -1000)
    blocks = [(np.arange(64) + 64 * i, m.astype(np.int64)) for i, m in enumerate([near, far, far])]
    _, _, scored = topk.best_of_group(np.array([-5]), np.full((1, 4), 10, np.int64), blocks, 5)
    assert scored == 1


def test_scores_beyond_64_bits_raise(spark):
    rows = spark.createDataFrame([(50, [1e10]), (51, [1e10])], "vec_id long, embedding array<double>")
    v = topk.quantised(rows)
    with pytest.raises(Exception, match="pass 64 bits"):
        topk.top_k(v, v.where("id % 50 = 0")).collect()
    fine = topk.quantised(spark.createDataFrame([(50, [1e6]), (51, [-1e6])], "vec_id long, embedding array<double>"))
    assert topk.top_k(fine, fine.where("id = 50")).first().score == -(256 * 10**6) ** 2
