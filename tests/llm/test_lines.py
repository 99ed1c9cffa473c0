import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlens.llm import lines


def slow(rows, least=20, docs=3):
    """{row: (n_lines, n_dropped, text)}"""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\v\f\r"))
    held = defaultdict(list)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(d)
    bad = {k: max((d for d in ds if d is not None), default=None) for k, ds in held.items() if len(k) >= least and len(ds) >= docs}
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if key(x) not in bad or bad[key(x)] == d]
        out.append((d, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(frame, **kw):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(frame, **kw).collect()), key=str)


def test_cases(docs):
    line = "A line of words that is long enough"
    rows = [
        (0, None), (1, ""), (2, line), (3, f"  {line.upper()}\t\nx\n\n{line}"), (4, f"{line}\nshort\n{line}"), (5, "short\nshort"), (6, "short"),
        (7, "é" * 20), (8, "É" * 20), (9, "é" * 20 + "\r"), (10, "\v" + "é" * 20), (11, "k" * 200_000), (12, "k" * 200_000), (13, "k" * 200_000 + "\n"), (14, f"{line}x"),
        (4, f"{line}\nshort\n{line}"), (None, line), (None, "k" * 200_000),
    ]
    frame = docs(rows)
    assert run(frame) == slow(rows)
    assert lines.dedup_lines(frame).columns == [*frame.columns, "n_lines", "n_dropped"]


def test_no_rows(docs):
    assert run(docs([])) == []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["", "ab", " Long line number one here", "long line NUMBER one here ", "another line of twenty chars", "third  line of twenty chars"]), max_size=6), max_size=9))
def test_any_mix(docs, texts):
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    assert run(docs(rows)) == slow(rows)


def test_full_filters_change_no_result(docs):
    rows = [(i, "\n".join([f"own line number {i} {j} of some words" for j in range(40)] + ["a common line with enough words"])) for i in range(30)]
    assert run(docs(rows), segment_bits=3, filter_bits=4) == slow(rows)
    assert run(docs(rows), segment_bits=8, filter_bits=12) == slow(rows)
