import math
import re
from collections import Counter

from pyspark.sql import functions as F

from playlens.llm import quality, queries
from tests.conftest import SMALL


def slow(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_of_the_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op2_quality(spark, SMALL).collect()}
    assert got == {d: slow(t) for d, t in texts.items()}


def test_odd_texts(docs):
    texts = [None, "", "\t\r\n", "a b", "a b c a b c", "x x x x x x", "é\U0001f600 b\vc", "l\nl\n l\nl", "#" * 60_000 + " a", "a b c d " * 9000, " \x85 ", "A!\nB!"]
    frame = docs(texts).unionAll(docs([(3, "a b"), (None, "a b")])).withColumnRenamed("n", "quality")
    out = quality.judge(frame)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect())) == sorted(slow(t) for t in [*texts, "a b", "a b"])
    assert not [r for r in out.collect() if r.kept and r.base_failed]
    assert quality.judge(docs([])).count() == 0


def test_fit_equals_plain_loops(spark):
    votes = ["a", "b", "c"]
    rows = [(1, 0, 0, 500), (0, -1, 0, 40), (0, -1, -1, 60), (1, -1, 0, 7), (-1, 0, 1, 90), (0, 0, 0, 30)]
    got = quality.fit(spark.createDataFrame(rows, "a int, b int, c int, n long"), votes)
    prior, good, bad = quality.GOOD, [quality.ON_GOOD] * 3, [quality.ON_BAD] * 3
    total = sum(r[3] for r in rows)
    belief = quality.BELIEF * total
    chance = lambda two, v: two[0] if v == 1 else two[1] if v == -1 else 1 - sum(two)
    for _ in range(quality.ROUNDS):
        p = []
        for *v, n in rows:
            a, b = prior * math.prod(chance(g, x) for g, x in zip(good, v)), (1 - prior) * math.prod(chance(g, x) for g, x in zip(bad, v))
            p.append(a / (a + b))
        mass = sum(x * r[3] for x, r in zip(p, rows))
        side = lambda q, m, start: [tuple((sum(x * r[3] for x, r in zip(q, rows) if r[j] == v) + belief * start[i]) / (m + belief) for i, v in enumerate((1, -1))) for j in range(3)]
        new = (mass + belief * quality.GOOD) / (total + belief), side(p, mass, quality.ON_GOOD), side([1 - x for x in p], total - mass, quality.ON_BAD)
        change = max(abs(a - b) for a, b in zip([new[0], *sum(map(list, new[1] + new[2]), [])], [prior, *sum(map(list, good + bad), [])]))
        prior, good, bad = new
        if change < quality.STILL:
            break
    flat = lambda m: [m[0], *sum(map(list, m[1] + m[2]), [])]
    assert all(abs(a - b) < 1e-9 for a, b in zip(flat(got), flat((prior, good, bad))))


def test_verdict_follows_the_labels(spark):
    sf = SMALL.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = queries.op2_quality(spark, sf).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == (r.label == 1) for r in rows) >= 0.97 * len(rows) and len(rows) > 200
    assert all(r.kept for r in rows if r.label == 1)


def test_main_path_is_native(spark):
    plan = quality.judge(queries.documents(spark, SMALL))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
