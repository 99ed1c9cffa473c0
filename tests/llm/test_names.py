"""Columns of the input that are named like the operators' own come through."""

import pytest
from pyspark.sql import functions as F

from playlens.llm import align, bpe, lines, lm, mixing, pii, quality, queries, simhash, toxicity, urls, windows
from playlens.llm.common import prepare

NAMES = ["__id", "__t", "__text", "__key", "__th", "__lost", "__own", "__score", "__X", "__tokens", "__rate", "__copies", "__w", "__l", "__node", "__alias", "__v0", "__n_words", "__ranges", "__copy"]


def labels(spark):
    return spark.createDataFrame([(0, 1), (1, 0), (3, 0)], "doc_id long, toxic int")


def domains(spark):
    return spark.createDataFrame([(0, "prime"), (1, "rough"), (3, "rough")], "doc_id long, domain string")


RUNS = {
    "lines": lambda s, d: lines.dedup_lines(d),
    "mixing": lambda s, d: mixing.mix(d, domains(s)),
    "windows": lambda s, d: windows.remove_repeats(d, width=20, digit=8),
    "quality": lambda s, d: quality.judge(d),
    "pii": lambda s, d: pii.find(d),
    "toxicity": lambda s, d: toxicity.score(d, labels(s)),
    "bpe": lambda s, d: bpe.encode_documents(d, queries.vocabulary_path()),
    "simhash": lambda s, d: simhash.keep_one(d),
    "align": lambda s, d: align.judge_links(align.align(d, queries.vocabulary_path(), queries.pieces_path())),
    "lm": lambda s, d: lm.score(d),
}


def named(spark):
    prepare(spark)
    texts = ["one text of words a@b.cc", "another text\nof two lines", None, "one more text", ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return frame.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})


@pytest.mark.parametrize("name", sorted(RUNS))
def test_documents(spark, name):
    out = RUNS[name](spark, named(spark))
    assert set(NAMES) <= set(out.columns)
    rows = out.collect()
    assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in NAMES)


def test_pages(spark):
    prepare(spark)
    frame = spark.createDataFrame([(0, "http://a.net/x", "<html></html>"), (1, None, None)], "page_id long, url string, html string")
    frame = frame.withColumns({n: F.concat(F.lit(f"{n} "), F.col("page_id").cast("string")) for n in NAMES})
    rows = urls.judge(frame).collect()
    assert len(rows) == 2 and all(r[n] == f"{n} {r.page_id}" for r in rows for n in NAMES)


def test_columns_that_the_operator_is_told_of(spark):
    frame = named(spark).drop("__text", "__id").withColumnsRenamed({"text": "__text", "doc_id": "__id"})
    out = lines.dedup_lines(frame, "__text", doc_id="__id")
    assert {"__text", "__id", "n_lines"} <= set(out.columns) and out.where("__id = 1").first()["n_lines"] == 2
