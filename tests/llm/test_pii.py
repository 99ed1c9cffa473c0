import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlens.llm import pii, queries
from tests.conftest import SMALL

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, s):
    d = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def slow(text):
    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


CASES = [
    "", "a@b", "a@b.c", "a@b@c.d e", "x a.b+c@d-e.f.g@h.i", "@@a@b.c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "+1 (017) 555-7713", "+12((((((((", "+1+12 345 678 90",
    "+49.30.123456.", "0" * 3000, "9" * 50 + ".1.1.1", "a" * 3000 + "@", "1 " * 2000, "a@b." * 800 + "c", "١٢٣٤٥٦٧٨٩٠١٢٣ é@é.é", "+1 (826) 555-4081 190.137.223.20",
]


@pytest.mark.parametrize("text", CASES, ids=range(len(CASES)))
def test_base_equals_the_patterns(text):
    assert pii.base_spans(text) == slow(text)


def test_very_long_numbers_in_an_address():
    zeros = "0" * 6000
    assert pii.base_spans(f"x {zeros}.1.1.1") == [("ip", 2, 6008)]
    assert pii.base_spans(f"x {zeros}.1.1.{'7' * 6000}") == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-+ 012459()\n%é", max_size=50))
def test_base_of_any_text_equals_the_patterns(text):
    assert pii.base_spans(text) == slow(text)


@pytest.fixture(scope="module")
def model():
    islands = [
        "Shre hewhha thlystti +1 (017) 555-7713 rethsh on", "call +1 (136) 555-7479 of", "und.34@mail7.example.com geiever vererbe", "ly.39@mail1.example.com erou", "el la 97.51.17.173 ueadoos", "on 127.204.92.12 tind",
        "re 4111111111111111 of", "th 4012 8888 8888 1881 on", "+1 (205) 555-1234 re", "an.1@mail2.example.com is",
    ]
    return pii.train([(t, pii.base_spans(t)) for t in islands])


def added(text, w):
    base, spans = pii.all_spans(text, w)
    assert set(base) <= set(spans)
    return [(k, text[s:e]) for k, s, e in spans if (k, s, e) not in base]


def test_model_adds_what_patterns_miss(model):
    assert added("call (017) 555-7713 now", model) == [("phone", "(017) 555-7713")]
    assert added("mail joe.x [at] corp [dot] com ok", model) == [("email", "joe.x [at] corp [dot] com")]


def test_model_leaves_clean_numbers_alone(model):
    for t in ("licensed under CC BY-NC 4.0.", "in 1998 and 2005, 12 of 30", "Version 3.", "on 2024-01-05 we met", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "pages 10-12"):
        assert added(t, model) == []


def test_added_spans_do_not_touch_base_ones(model):
    text = "und.34@mail7.example.com (017) 555-7713 97.51.17.173 " * 5
    base, spans = pii.all_spans(text, model)
    taken = [x for _, s, e in base for x in range(s, e)]
    assert not [1 for k in spans if k not in base and set(range(*k[1:])) & set(taken)]


def test_dynamic_program_equals_trying_all(model):
    for text in ("call (017) 555-7713 or 1.2.3.4 x", "a@b.cc 12 34"):
        part = pii.Part(text, 0, len(text))
        top = (part.x @ model).max(1)

        def best(at):
            if at >= len(part.cuts) - 1:
                return 0.0
            return max([best(at + 1), *(top[k] + best(j) for k, (i, j) in enumerate(part.spans) if i == at)])

        place = {c: i for i, c in enumerate(part.cuts)}
        score = sum((part.x @ model)[part.spans.index((place[s], place[e])), pii.KINDS.index(k)] for k, s, e in part.best(model))
        assert abs(score - best(0)) < 1e-9


def test_long_stretches_are_decoded_whole(model):
    for shift in range(0, 24, 5):
        text = "x" * shift + " call (017) 555-7713 now, costs 12 or 7," * 250
        lo, hi = next(pii.stretches(text, []))
        assert hi - lo > 8000
        assert pii.decoded(text, lo, hi, model) == pii.Part(text, lo, hi).best(model)
        assert added(text, model).count(("phone", "(017) 555-7713")) == 250


@pytest.mark.parametrize("mail", [
    "jane [at] computer-science [dot] stanford [dot] edu", "jane.doe [at] cs [dot] uni [dot] ac [dot] uk", "first [dot] last [at] sub [dot] domain [dot] org",
    "jane [at] institute-for-computational-linguistics-and-phonetics [dot] uni [dot] org",
])
def test_long_written_out_domains(model, mail):
    text = f"mail {mail} ok"
    part = pii.Part(text, *next(pii.stretches(text, [])))
    assert (5, 5 + len(mail)) in [(part.cuts[i], part.cuts[j]) for i, j in part.spans]
    assert added(text, model) == [("email", mail)]


def test_every_variant_of_a_training_passage_fits():
    for own in ("a.b.c.d.e.f.g.h.i.j.k@l.m.n.o.p.q.r.s.t.u.v.w.x.y.z.a.b.cd", "first.last@sub.domain.org", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "+1 (017) 555-7713"):
        text = f"re {own} of"
        assert pii.base_spans(text)
        for t, spans in pii._variants(text, pii.base_spans(text)):
            part = pii.Part(t, 0, len(t))
            assert {(s, e) for _, s, e in spans} <= {(part.cuts[i], part.cuts[j]) for i, j in part.spans}


def test_gradient_equals_differences(model):
    import numpy as np

    part = pii.Part("tel (017) 555-7713 of", 0, 21)
    gold = {part.spans[3]: 3}
    _, g = part.slope(model, gold)
    rng = np.random.default_rng(0)
    d = rng.normal(size=model.shape)
    up, down = part.slope(model + 1e-5 * d, gold)[0], part.slope(model - 1e-5 * d, gold)[0]
    assert abs((up - down) / 2e-5 - (g * d).sum()) < 1e-5


def test_query(spark):
    got = {r.doc_id: r for r in queries.op4_pii(spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        base = [f"{k}:{s}:{e}" for k, s, e in slow(t)]
        assert got[d].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k + ":") for b in base) for k in pii.KINDS]
        assert set(base) <= set(got[d].spans.split(",")) | ({""} if not base else set())
    assert sum(len(r.spans) for r in got.values()) > 0


def test_odd_rows(docs):
    frame = docs([None, "", "no numbers", "mail a@b.cc", (3, "mail a@b.cc"), (None, "a@b.cc"), "1" * 100_000, "(1" * 20_000]).withColumnRenamed("n", "spans")
    rows = sorted(((r.doc_id, len(r.base), len(r.spans)) for r in pii.find(frame).collect()), key=str)
    assert [r[:2] for r in rows] == [(0, 0), (1, 0), (2, 0), (3, 1), (3, 1), (6, 0), (7, 0), (None, 1)]
    assert pii.find(docs([])).count() == 0


def planted(seed):
    """Passages with one entity in a form that no base pattern takes, or a decoy: (text, (kind, entity) or None)."""
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(good):
        while True:
            d = rng.choice("3456") + digits(15)
            if pii.luhn(d) == good:
                return d

    out = []
    for i in range(240):
        kind = i % 8
        mail = (word(), word(), rng.choice(["com", "org", "net", "de"]))
        own = [
            ("email", f"{mail[0]}.{word()} [at] {mail[1]} [dot] {mail[2]}"), ("email", f"{mail[0]}(at){mail[1]}(dot){mail[2]}"),
            ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"),
            (None, card(False)), (None, f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"), (None, digits(rng.randint(10, 11))), (None, " ".join(x[0] for x in [[card(False)[j : j + 4]] for j in range(0, 16, 4)])),
        ][kind]
        if own[0] is None and pii.base_spans(own[1]):
            continue
        text = " ".join([*(word() for _ in range(rng.randint(2, 8))), own[1], *(word() for _ in range(rng.randint(2, 8)))])
        out.append((text, own if own[0] else None))
    return out


def test_precision_and_recall_on_planted_passages(spark):
    """Of the model that the query fits, on passages that it hasn't seen."""
    w = pii.fit(spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text"))
    right = wrong = there = 0
    for text, want in planted(5):
        got = added(text, w)
        there += want is not None
        right += want in got
        wrong += len([g for g in got if g != want])
    assert right >= 0.9 * there > 90 and right >= 0.9 * (right + wrong), (right, wrong, there)
