import pickle
import random
import zlib
from math import sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import queries, toxicity
from tests.conftest import SMALL

MIDDLE = SMALL.replace("sf0.001", "sf0.01")


def test_index_equals_brute_force():
    rng = random.Random(0)
    idf = {f"w{i}": 1 + rng.random() for i in range(12)}
    some = lambda: {w: rng.randint(1, 4) for w in rng.sample(list(idf), rng.randint(1, 4))}
    examples = [(rng.randint(0, 10**6), rng.randint(0, 1), some()) for _ in range(500)]
    index = toxicity.Index(idf, examples, 0.1, 0.2)
    ordered = sorted(examples, key=lambda e: e[0])

    def cosine(a, b):
        return round(sum(x * index.vector(b).get(w, 0) for w, x in index.vector(a).items()), 9)

    skipped = 0
    for _ in range(60):
        q = some()
        want = sorted(((-cosine(q, c), i) for i, (_, _, c) in enumerate(ordered)))[: toxicity.NEAREST]
        got, scored = index.nearest(index.vector(q))
        assert [i for _, i in got] == [i for _, i in want] and all(abs(a[0] + b[0]) < 2e-9 for a, b in zip(got, want))
        skipped += index.blocks - scored
    assert skipped > 0
    assert all(abs(sqrt(sum(x * x for x in index.vector(c).values())) - 1) < 1e-9 for _, _, c in examples[:9])


def test_held_out_rows(spark):
    frame = spark.range(300).select("id", toxicity.held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in frame.collect())


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = [r for r in queries.op5_toxicity(spark, MIDDLE).collect()]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    apart = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = [r for r in apart if labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic) and len(toxic) > 4
    clean = [r for r in apart if not labels[r.doc_id]]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    brier = sum((r.score - labels[r.doc_id]) ** 2 for r in apart) / len(apart)
    share = len(toxic) / len(apart)
    assert brier < 0.5 * share * (1 - share)


def made(spark, docs, labelled=True):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    texts, labels = [], []
    for i in range(160):
        ws = [word() for _ in range(30)]
        if i % 4 == 0:
            ws[rng.randrange(30)], ws[rng.randrange(30)] = "Vile", "vile"
        texts.append(" ".join(ws))
        labels.append((i, int(i % 4 == 0)))
    texts += [None, "", "nice vile day", "nice day " * 30_000, "nice " * 30_000 + "VILE"]
    frame = docs(texts).unionAll(docs([(162, "nice vile day"), (None, "vile")])).withColumnRenamed("n", "score")
    return frame, spark.createDataFrame((labels + [(0, 0), (None, 1), (999, 1), (5, None)]) if labelled else [], "doc_id long, toxic int")


def test_odd_rows_and_evidence(spark, docs):
    frame, labels = made(spark, docs)
    rows = toxicity.score(frame, labels).collect()
    assert len(rows) == 167
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len({(r.score, r.predicted) for r in by[162]}) == 1 and by[162][0].predicted == 1 and by[164][0].predicted == 1
    assert by[160][0].score == by[161][0].score == by[163][0].score < 0.3 and by[160][0].evidence == []
    assert by[None][0].predicted == 1 and by[None][0].held_out is False
    assert all(e.doc_id < 160 and zlib.crc32(str(e.doc_id).encode()) % 4 != 2 for e in by[162][0].evidence) and by[162][0].evidence


def test_copies_do_not_make_words_speak(spark, docs):
    frame, labels = made(spark, docs)
    copies = docs([(1000 + i, f"plain words of one text that is copied {i % 3}") for i in range(60)]).withColumnRenamed("n", "score")
    more = spark.createDataFrame([(1000 + i, 1) for i in range(60)], "doc_id long, toxic int")
    index = toxicity.learn(frame.unionAll(copies), labels.unionAll(more))
    assert set(index.idf) == {"vile"}


def test_no_labels_or_rows(spark, docs):
    frame, none = made(spark, docs, labelled=False)
    assert {r.score for r in toxicity.score(frame, none).collect()} == {0.5}
    assert toxicity.score(docs([]), none).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark, docs):
    frame, labels = made(spark, docs)
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = ({(r.doc_id, r.score) for r in toxicity.score(frame, x, evidence=None).collect()} for x in (labels, other))
    assert a == b


def test_all_words_and_clean_examples_vote(spark, docs):
    frame, labels = made(spark, docs)
    index = toxicity.learn(frame, labels)
    learned = {i for i in range(160) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(index.ids.tolist()) == learned
    texts = {r.doc_id: r.text for r in frame.collect() if r.doc_id in learned}
    assert set(index.number) == {w for t in texts.values() for w in toxicity.words(t)}
    rows = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    for i in learned:
        assert rows[i].evidence[0].doc_id == i and abs(rows[i].evidence[0].cosine - 1) < 1e-8
    # a long clean text that quotes the word once is near to clean examples
    clean = [texts[i] for i in sorted(learned) if i % 4][:3]
    more = docs([(900, " ".join([*clean, "vile"]))]).withColumnRenamed("n", "score")
    row = next(r for r in toxicity.score(frame.unionAll(more), labels).collect() if r.doc_id == 900)
    assert max(e.cosine for e in row.evidence) < 0.99 and any(e.label == 0 for e in row.evidence)


def test_index_of_common_and_rare_words_equals_brute_force():
    rng = random.Random(1)
    rest = {f"w{i}": 0.1 + rng.random() * (1 + i / 40) for i in range(400)}
    some = lambda: {f"w{min(399, int(rng.expovariate(0.02)))}": rng.randint(1, 3) for _ in range(25)}
    examples = [(i, i % 2, some()) for i in range(700)]
    index = toxicity.Index({"vile": 9.0}, examples, 0.1, 0.2, rest)
    index.nearest({})
    assert 0 < index.whole.shape[1] < 400
    vectors = [index.vector(c) for _, _, c in examples]
    for _ in range(40):
        q = index.vector(some())
        want = sorted((-round(sum(x * v.get(w, 0) for w, x in q.items()), 9), i) for i, v in enumerate(vectors))[: toxicity.NEAREST]
        got, _ = index.nearest(q)
        assert [i for _, i in got] == [i for _, i in want] and all(abs(a[0] + b[0]) < 2e-9 for a, b in zip(got, want))


def shared(spark, folder, percent):
    """Tables of 600 documents, ``percent`` of them toxic by one of six words, and the toxic ids."""
    rng = random.Random(percent)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    toxic = {i for i in range(600) if rng.randrange(100) < percent}
    texts = []
    for i in range(600):
        ws = [word() for _ in range(20)]
        if i in toxic:
            ws[rng.randrange(20)] = ws[rng.randrange(20)] = rng.choice(["vile", "scum", "trash", "moron", "loser", "idiot"])
        texts.append((i, " ".join(ws)))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(600)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return toxic


@pytest.mark.parametrize("percent", [50, 80])
def test_shares_of_a_half_and_more(spark, tmp_path, percent):
    import corpus_pipeline

    toxic = shared(spark, tmp_path, percent)
    called = {r.doc_id for r in queries.op5_toxicity(spark, str(tmp_path)).collect() if r.held_out and r.predicted}
    apart = {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(called & toxic) >= 0.9 * len(apart & toxic) and len(called - toxic) <= 0.1 * len(apart - toxic)
    kept = {r.doc_id for r in corpus_pipeline.reject_toxic(spark, queries.documents(spark, str(tmp_path)), str(tmp_path)).collect()}
    assert len(kept - toxic) >= 0.9 * (600 - len(toxic)) and len(kept & toxic) <= 0.1 * len(toxic)


def test_numbers_of_words_take_little_memory_and_stay_exact(monkeypatch):
    words = [f"{'é' * (i % 9)}{i}" for i in range(50_000)]
    numbers = toxicity.Numbers(words)
    assert (numbers.of(words[::-1]) == np.arange(len(words))[::-1]).all() and len(numbers.of([])) == 0
    assert len(pickle.dumps(numbers)) < 13 * len(words)  # a dictionary in each task before
    clash = lambda self, ws: np.array([len(w) if self.seed < 2 else int(w) for w in ws], np.uint64)
    monkeypatch.setattr(toxicity.Numbers, "_hashes", clash)
    numbers = toxicity.Numbers(["7", "3", "12"])  # equal hashes until the seed is 2
    assert numbers.seed == 2 and numbers.of(["12", "7", "3"]).tolist() == [2, 0, 1]
    assert toxicity.Numbers([]).of([]).tolist() == []


def test_a_searching_task_drops_what_it_has_packed():
    rng = np.random.default_rng(3)
    counts = [{f"w{k}": 1 for k in rng.choice(900, 60, replace=False)} for _ in range(300)]
    index = toxicity.Index({f"w{k}": 1.0 + k % 7 for k in range(900)}, [(i, i % 2, c) for i, c in enumerate(counts)], 0.1, 0.2)
    found, _ = index.nearest(index.vector(counts[5]))
    assert found[0] == (1.0, 5) and index.nearest(index.vector(counts[5]))[0] == found
    assert index.example is None and index.weight is None
