import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlens.llm import phrases


def counted(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def slow(rows, longest=3, support=10, absorb=50, top=2000):
    f, n = counted(rows, longest)
    out = []
    for lang, c in f.items():
        kept = []
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        for p, a in some.items():
            if any(100 * b >= absorb * a for q, b in some.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def frame(spark, rows):
    """With columns named as the operator's own."""
    return spark.createDataFrame([(lang, text, 1, "x", 2.0, 3) for lang, text in rows], "lang string, text string, shard int, phrase string, a double, n int")


def fast(spark, rows, **kw):
    return sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), **kw).collect())


CASES = [
    ("en", "New York city is New York, new york! New\tYork city\nnew york city. In New York city"), ("en", None), (None, "new york new york new york"), ("und", "New York"), ("en", ""),
    ("de", "   "), ("de", "ä ö ä ö ä ö Ä ö é́ ä ö"), ("de", "ä\x0bö\x0cä\rö ä\x1cö"), ("en", "a b " * 400), ("en", "new york city " * 30), ("", "x y x y x y"), ("en", "z " * 5000),
    ("en", "new york city " * 30), ("fr", "one two three four five six seven eight nine ten"), ("en", "\x00 \x00 \x00 \x00"),
]


@pytest.mark.parametrize("more", [{}, {"shard": 40, "bin_size": 7}, {"support": 2, "shard": 300}, {"support": 1, "longest": 2}, {"support": 3, "longest": 4, "shard": 100, "absorb": 90, "top": 3}, {"support": 300, "shard": 500}])
def test_cases(spark, more):
    kw = {k: v for k, v in more.items() if k not in ("shard", "bin_size")}
    assert fast(spark, CASES, **more) == slow(CASES, **kw)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["en", None]), st.lists(st.sampled_from(["a", "B", "c", "a b", ". ", ",", "\n", "\t", "d e f"]), max_size=40).map(" ".join)), max_size=8), st.sampled_from([10, 60, 1 << 20]), st.integers(1, 5))
def test_any_texts(spark, rows, shard, support):
    assert fast(spark, rows, support=support, shard=shard, bin_size=11) == slow(rows, support=support)


def test_supports_never_lose_a_phrase():
    for sizes in ([100], [50, 50], [1] * 40, [97, 1, 1, 1], [30, 30, 40], [333, 333, 334, 0]):
        for support in (1, 2, 10, 25):
            assert sum(phrases.lowered(support, n, sum(sizes)) - 1 for n in sizes) < support


def test_counts_beyond_64_bits(spark):
    """The score's products: 1000000 * a * a with a of 13 digits."""
    a, l, r = 9_999_999_999_999, 99_999_999_999_999, 12_345_678_901_234
    out = spark.range(1).selectExpr(f"{a} AS a", f"{l} AS l", f"{r} AS r").selectExpr(f"{phrases.SCORE} AS s").first().s
    assert out == 1000000 * a * a // (l * r)


def test_no_rows(spark):
    assert fast(spark, []) == [] == fast(spark, [("en", None)])
