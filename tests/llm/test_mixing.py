import numpy as np
import pytest

from playlens.llm import mixing, queries
from tests.conftest import SMALL


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, domain string")


LOUD, CALM = "LOUD WORDS!! AND MORE ###", "calm words and more of them here"


def test_targets_are_met_in_expectation(spark):
    got = queries.op10_mixing(spark, SMALL.replace("sf0.001", "sf0.01")).collect()
    prime, rough = (sum(r.rate * r.n_tokens * r[k] for r in got) for k in ("p_prime", "p_rough"))
    assert abs(prime / (prime + rough) - 0.9) < 1e-4
    assert all(r.rate >= 0 and abs(r.p_prime + r.p_rough - 1) < 1e-9 and abs(r.copies - r.rate) < 1 for r in got)
    # no domain is thinned as a whole
    assert prime >= sum(r.n_tokens * r.p_prime for r in got) * 0.999 and rough >= sum(r.n_tokens * r.p_rough for r in got) * 0.999
    drawn = sum(r.copies * r.n_tokens * r.p_prime for r in got) / sum(r.copies * r.n_tokens for r in got)
    assert abs(drawn - 0.9) < 0.03


def test_posterior_follows_held_out_labels(spark):
    sf = SMALL.replace("sf0.001", "sf0.01")
    docs, named = queries.documents(spark, sf), queries.quality_domains(spark, sf)
    out = mixing.mix(docs.select("doc_id", "text"), named.where("doc_id % 2 = 0")).join(named.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [(r.posterior[0] > 0.5) == (r.domain == "prime") for r in out]
    assert len(right) > 100 and np.mean(right) > 0.9


@pytest.mark.parametrize("targets", [(0.7, 0.3), (0.02, 0.98), (0.0, 1.0), (0.5, 0.2, 0.3), (0.05, 0.05, 0.9)])
def test_rates_solve_the_least_squares(spark, targets):
    rng = np.random.default_rng(1)
    d = len(targets)
    n, p = rng.integers(1, 500, 300), rng.dirichlet([0.4] * d, 300)
    frame = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "__tokens long, __x array<double>")
    moves = mixing.solve(frame, np.array(targets), float(n.sum()))
    r = np.ones(300)
    for m in moves:
        r = np.maximum(0, r - p @ m)
    got = np.array([x[0] for x in frame.select(mixing._rate(moves)).collect()])
    assert np.allclose(got, r, atol=1e-9) and (got >= 0).all()
    miss = np.abs(p.T @ (n * got) / n.sum() - targets).max()
    assert miss < (1e-5 if min(targets) else 0.1)
    if min(targets) < 0.1:
        assert (got == 0).any()


def test_odd_rows(spark, docs):
    texts = [None, "", LOUD, CALM, LOUD * 3, CALM * 20_000, LOUD + "x", CALM + "y"]
    frame = docs(texts).unionAll(docs([(3, CALM), (None, CALM)])).withColumnRenamed("n", "rate")
    named = labels(spark, [(2, "rough"), (4, "rough"), (3, "prime"), (5, "prime"), (5, "zz"), (None, "prime"), (99, "prime"), (1, None)])
    rows = mixing.mix(frame, named).collect()
    assert len(rows) == 10 and len({(tuple(r.posterior), r.rate, r.copies) for r in rows if r.doc_id == 3}) == 1
    assert [r.n_tokens for r in sorted(rows, key=lambda r: str(r.doc_id))][:2] == [0, 0]
    p = {r.doc_id: r.posterior[0] for r in rows}
    assert p[3] > 0.5 > p[2]
    again = {(r.doc_id, r.copies) for r in mixing.mix(frame.repartition(5), named).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def test_without_labels_or_rows(spark, docs):
    rows = mixing.mix(docs([LOUD, CALM]), labels(spark, [])).collect()
    assert {tuple(r.posterior) for r in rows} == {(0.5, 0.5)}
    assert mixing.mix(docs([]), labels(spark, [(1, "prime")])).count() == 0


def test_resample(spark, docs):
    frame = docs([CALM, LOUD, CALM])
    from pyspark.sql import functions as F

    out = mixing.resample(frame.withColumn("copies", F.col("doc_id")), frame.columns)
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 2] and out.columns == frame.columns
