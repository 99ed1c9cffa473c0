import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playlens.llm import bpe, queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary_path())


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


CASES = ["", " ", "a<|endoftext|>b <|endoftext|>", "<|endoftext|", "   \n\n  x  ", "\x85 \x1c\x1d a", "日本語 ½²³ don't I'LL  　 z", "a" * 5000, "!?" * 500, "ab" * 3000 + "\U0001f600", "x​ y\n", "\x00"]


def test_cases_equal_the_library(library):
    c = bpe.codec(queries.vocabulary_path())
    for t in CASES:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(c, t) == want
        assert c.decode(c.encode(t)) == library.decode(want, skip_special_tokens=False) == t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(t):
    c = bpe.codec(queries.vocabulary_path())
    library = Tokenizer.from_file(queries.vocabulary_path()) if not hasattr(test_any_text_equals_the_library, "lib") else test_any_text_equals_the_library.lib
    test_any_text_equals_the_library.lib = library
    assert ids(c, t) == library.encode(t, add_special_tokens=False).ids
    assert c.decode(c.encode(t)) == t


def test_broken_bytes_decode_to_replacement(library):
    c = bpe.codec(queries.vocabulary_path())
    some = ids(c, "\U0001f600")[:1]
    assert c.decode(np.array(some, "<u4").tobytes()) == library.decode(some, skip_special_tokens=False)


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    c = bpe.Codec(queries.vocabulary_path())
    text = "one two three four five six one two three unbelievably one"
    assert ids(c, text) == ids(c, text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_bpe(spark, SMALL).collect()}
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        e = library.encode(r.text or "", add_special_tokens=False).ids
        d = library.decode(e, skip_special_tokens=False)
        want[r.doc_id] = (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())
    assert got == want


def test_nulls_repeats_and_clashing_columns(docs):
    frame = docs([None, "", "a b", (2, "a b")]).withColumnRenamed("k", "ids")
    out = bpe.encode_documents(frame, queries.vocabulary_path())
    assert sorted((r.doc_id, r.n_tokens, r.decoded) for r in out.collect()) == [(0, 0, ""), (1, 0, ""), (2, 2, "a b"), (2, 2, "a b")]
    assert bpe.encode_documents(docs([]), queries.vocabulary_path()).count() == 0


def test_a_worker_keeps_only_the_vocabulary():
    kept = bpe.Codec(queries.vocabulary_path())
    kept.encode("some pieces to remember, bxhqz")
    assert kept.known and kept.fits
    before = kept.encode("bxhqz again")
    kept.forget()
    assert not kept.known and not kept.before and not kept.fits and kept.encode("bxhqz again") == before


def test_a_task_leaves_nothing_remembered(spark, docs):
    out = bpe.encode_documents(docs([(1, "pieces to remember bxhqz")]), queries.vocabulary_path()).select("ids")
    left = lambda batches: ((pa.RecordBatch.from_arrays([pa.array([len(bpe.codec(queries.vocabulary_path()).known)])], names=["n"])) for _ in batches)
    assert out.count() == 1
    assert max(r.n for r in spark.range(64).repartition(8).mapInArrow(left, "n long").collect()) == 0
