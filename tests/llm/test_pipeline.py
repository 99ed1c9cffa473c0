from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from playlens.llm import mixing, queries, toxicity
from playlens.llm.common import checkpointed, documents, table
from tests.conftest import SMALL
from tests.llm.test_lines import slow as slow_lines
from tests.llm.test_simhash import slow_components, slow_print

MIDDLE = SMALL.replace("sf0.001", "sf0.01")
NAMES = [n for n, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def steps(spark):
    """What went into each stage and what came out of the last, by the stages one at a time."""
    frames = [documents(spark, MIDDLE)]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(checkpointed(stage(spark, frames[-1], MIDDLE), f"test-{name}"))
    return frames


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_order_and_columns(steps):
    assert NAMES == ["toxicity", "line_dedup", "simhash", "mixing", "bpe"]
    assert all(f.columns == steps[0].columns for f in steps[:-1])


def test_toxicity_by_all_cosines(spark, steps):
    """The first stage, and the query's scores, by each text's cosine to every example."""
    labels = table(spark, MIDDLE, "labels")
    index = toxicity.learn(steps[0], labels)
    scores = {r["doc_id"]: by_hand(index, r["text"]) for r in rows(steps[0])}
    stay = {d for d, s in scores.items() if s < toxicity.REJECT}
    assert {r["doc_id"] for r in rows(steps[1])} == stay and 0 < len(stay) < steps[0].count()
    asked = {r["doc_id"]: r for r in rows(queries.op5_toxicity(spark, MIDDLE))}
    assert scores.keys() == asked.keys() and all(abs(s - asked[d]["score"]) < 1e-6 and asked[d]["predicted"] == (asked[d]["score"] >= 0.3) for d, s in scores.items())
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(known[int(e.split(":")[0])] == int(e.split(":")[2]) for r in asked.values() for e in r["evidence"].split())


def by_hand(index, text):
    counts = Counter(w for w in toxicity.words(text) if w in index.number)
    if not counts:
        return index.none
    s = np.zeros(len(index.ids))
    for w, x in index.vector(counts).items():
        own = slice(index.at[index.number[w]], index.at[index.number[w] + 1])
        s[index.order[index.example[own]]] += x * index.weight[own]
    near = sorted(((round(float(c), 9), i) for i, c in enumerate(s)), key=lambda p: (-p[0], p[1]))[: toxicity.NEAREST]
    return index.voted(near, index.some if counts.keys() & index.idf.keys() else index.none)[0]


def test_lines_by_brute_force(steps):
    want = slow_lines([(r["doc_id"], r["text"]) for r in rows(steps[1])])
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in rows(steps[2])) == sorted((d, t, len(t)) for d, _, _, t in want)


def test_near_duplicates_by_brute_force(steps):
    before = [(r["doc_id"], slow_print(r["text"])) for r in rows(steps[2])]
    want = {c for c in slow_components(before)}
    assert sorted(r["doc_id"] for r in rows(steps[3])) == sorted(want) and len(want) < len(before)


def test_mixing_by_rates(spark, steps):
    mixed = mixing.mix(steps[3], queries.quality_domains(spark, MIDDLE)).collect()
    want = {r.doc_id: r.copies for r in mixed}
    got = Counter(r["doc_id"] for r in rows(steps[4]))
    assert got == Counter({d: n for d, n in want.items() if n})
    total = sum(r.rate * r.n_tokens for r in mixed)
    assert abs(sum(r.rate * r.n_tokens * r.posterior[0] for r in mixed) / total - 0.9) < 1e-4
    # documents that are surely good stay
    assert all(want[r.doc_id] >= 1 for r in mixed if r.posterior[0] > 0.99)


def test_ids_equal_the_library(steps):
    library = Tokenizer.from_file(queries.vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in rows(steps[4])}
    for r in rows(steps[5])[:300]:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want) and r["text"] == texts[r["doc_id"]]


def test_run_equals_the_stages(spark, steps):
    got = Counter((r["doc_id"], bytes(r["ids"])) for r in rows(corpus_pipeline.run(spark, MIDDLE)))
    assert got == Counter((r["doc_id"], bytes(r["ids"])) for r in rows(steps[5]))


def test_empty_and_odd_documents(spark, docs):
    for frame in (docs([]), docs([None, "", "a b", (2, "a b"), (None, "x"), "word " * 50_000])):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SMALL)
        frame.collect()
