from playlens.llm import urls
from playlens.llm.components import connected_components


def judged(spark, rows):
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, node string, root int")
    out = urls.judge(frame)
    assert out.columns == [*frame.columns, "host", "path", "rule", "verdict"]
    return [(r.host, r.path, r.rule, r.verdict) for r in out.orderBy("page_id").collect()]


def canonical(to):
    return f'<html><head><LINK href="{to}" rel="canonical"/></head>'


def test_rules(spark):
    got = judged(spark, [
        ("http://A.net/x?q#f", ""), ("http://www.example.net/en/1", None), ("http://example.net/en", ""), ("https://b.example.com/de/", ""), ("https://badexample.com/de/", ""),
        ("x.org/fr/", ""), (None, None), ("http://x.org/fr/a#b", ""), ("http://net", ""), ("http://net/", ""), ("", ""), ("http://http://net/", ""), ("http://É.NET/É", ""),
    ])
    assert got == [
        ("a.net", "/x", "net/", "block"), ("www.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/en", "net/", "block"), ("b.example.com", "/de/", "example.com/de/", "block"),
        ("badexample.com", "/de/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("x.org", "/fr/a", "org/fr/", "allow"), ("net", "", None, "block"), ("net", "/", "net/", "block"),
        ("", "", None, "allow"), ("http:", "//net/", None, "allow"), ("É.net", "/É", "net/", "block"),
    ]


def test_blocks_reach_aliases_over_links_and_allows_win(spark):
    refresh = '<meta content="0; URL=//spam.net/p" http-equiv="Refresh">'
    got = judged(spark, [
        ("http://a.com/1", refresh), ("http://b.com/2", canonical("http://a.com/1?utm_source=x")), ("http://b.com/sub/3", canonical("../none")), ("http://c.com/4", canonical("http://x.org/fr/ok")),
        ("http://d.com/5", canonical("http://c.com/4")), ("http://spam.net/q", canonical("http://c.com/4")), ("http://e.com/6", canonical("http://e.com/7.html")), ("https://e.com/7/#x", refresh), ("http://f.com/8", canonical("")),
        ("http://x.org/fr/y", canonical("http://z.net/w")), ("http://y.com/9", canonical("http://z.net/w")), ("http://a.com/1", refresh),
    ])
    assert [r[3] for r in got] == ["block", "block", "allow", "allow", "allow", "block", "block", "block", "allow", "allow", "allow", "block"]


def test_no_rows(spark):
    assert judged(spark, []) == []


def test_components_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    for n, m in ((1, 0), (300, 200), (300, 290), (60, 300)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + ([(i, i + 1) for i in range(900, 940)] + [(500, i) for i in range(501, 800)] if m else [])
        root = {x: x for p in pairs for x in p}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        want = {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in pairs)}
        frame = spark.createDataFrame([*pairs, (None, 1), (2, None)], "a long, b long")
        assert {r.node: r.root for r in connected_components(frame).collect()} == want
