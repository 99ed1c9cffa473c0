import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from playlens.llm import align, queries
from tests.conftest import SMALL

ODD = ["", " ", "a", "two words", "  lead and trail ", "<|endoftext|> </s> <s> <0x0A>", "tab\tline\nend\n", "日本語 ½ \U0001f600 é́", "x" * 3000, "a\x00b", "\xa0 ﻿ ①", "▁ literal", "don't 12345 !?!?", "ab " * 700]


@pytest.fixture(scope="module")
def plain():
    """Both encoders by their own libraries: (A ids with byte ends, B ids with byte ends), or None."""
    a, b = Tokenizer.from_file(queries.vocabulary_path()), SentencePieceProcessor(model_file=queries.pieces_path())
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def run(text):
        if not text:
            return None
        raw = f" {text}".encode()
        i, j = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        x = [bytes(letters[c] for c in a.id_to_token(k)) for k in i]
        y = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in j]
        if b"".join(x) != raw or b"".join(y) != raw:
            return None
        return [list(zip(ids, np.cumsum([len(t) for t in ts]).tolist(), [len(t) for t in ts])) for ids, ts in ((i, x), (j, y))]

    return run


def slow(sides):
    """(n_a, n_b, n_groups, n_overlaps, groups, links) by looking at all pairs."""
    if sides is None:
        return (0, 0, 0, 0, "", [])
    a, b = sides
    both = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    groups, lo = [], 0
    for e in both:
        groups.append("|".join(",".join(str(i) for i, x, _ in side if lo < x <= e) for side in (a, b)))
        lo = e
    near = defaultdict(list)
    for j, e, n in b:
        for at in range(e - n, e):
            near[at].append((j, e))
    overlaps = {(e, f) for _, e, n in a for at in range(e - n, e) for _, f in near[at]}
    ends = {f: j for j, f, _ in b}
    return len(a), len(b), len(both), len(overlaps), ";".join(groups), sorted((i, ends[e]) for i, e, _ in a if e in ends)


def fast(texts):
    p = align.pair(queries.vocabulary_path(), queries.pieces_path())
    return [(*r[:5], sorted((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in r[5])) for r in align.aligned(p, texts)]


def test_odd_texts(plain):
    assert fast([*ODD, None]) == [slow(plain(t)) for t in [*ODD, None]]
    assert fast(["▁ literal"])[0] == (0, 0, 0, 0, "", [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_text(plain, texts):
    assert fast(texts) == [slow(plain(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60))
def test_long_texts_are_cut_between_groups(plain, part):
    text = "An unbelievably long text\n\n  of words, 日本語 and \U0001f600\U0001f600 signs." * 4
    before, align.PART = align.PART, part
    try:
        assert fast([text, "short", text]) == [slow(plain(t)) for t in (text, "short", text)]
    finally:
        align.PART = before


def judged(texts, plain):
    """Rows of the contract."""
    all_ = [slow(plain(t)) for t in texts]
    count = Counter(x for r in all_ for x in r[5])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*r[:3], len(r[5]), sum(count[x] == most[x[1]] for x in r[5]), sum(count[x] for x in r[5]), hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "", r[3]) for r in all_]


@pytest.mark.parametrize("head", [0, 7, align.HEAD])
def test_corpus_counts(docs, plain, head):
    texts = [*ODD, None, *ODD[:5], "the cat and the dog", "the cat; the dog", "THE DOG"]
    frame = docs(texts)
    clash = [c for c in frame.columns if c != "text"]
    out = align.judge_links(align.align(frame, queries.vocabulary_path(), queries.pieces_path()), head)
    assert out.columns == [*clash, *align.NEW[:5], "n_links", "n_best", "count_sum"]
    got = sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.n_overlaps) for r in out.collect())
    assert got == sorted((i, *r[:6], r[7]) for i, r in enumerate(judged(texts, plain)))


def test_no_rows_and_clashing_names(docs):
    frame = docs([]).withColumnRenamed("k", "u").withColumnRenamed("n", "pairs")
    out = align.judge_links(align.align(frame, queries.vocabulary_path(), queries.pieces_path()))
    assert out.count() == 0
    frame = docs(["a b", "a b", (None, None)]).withColumnRenamed("k", "u").withColumnRenamed("n", "pair").withColumnRenamed("id", "row")
    out = align.judge_links(align.align(frame, queries.vocabulary_path(), queries.pieces_path()))
    assert sorted((r.u, r.pair, r.n_links, r.n_best, r.count_sum) for r in out.collect()) == [(7, "x", 0, 0, 0), (7, "x", 2, 2, 4), (7, "x", 2, 2, 4)]


def test_query_by_hand(spark, plain):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = queries.op11_align(spark, SMALL)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]
    assert out.columns == names
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((r.doc_id, *x) for r, x in zip(rows, judged([r.text for r in rows], plain)))
