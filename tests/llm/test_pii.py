from __future__ import annotations

import random
import re

import pytest

from filingframe.llm import pii

COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"]
SCHEMA = "doc_id long, text string, text_hash long, kind string, start long, spans string, own_doc_id long, known string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), *x[1:])))


def card(rng):
    digits = "4" + "".join(rng.choices("0123456789", k=14))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def personal(rng):
    ip = ".".join(str(rng.randrange(1, 256)) for _ in range(4))
    phone = f"+1 ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    return [f"u{rng.randrange(999)}@mail{rng.randrange(9)}.example.com", ip, card(rng), phone]


WORDS = "the of look at house. and reads, in 12 3.5 2019-04-01 chapter é 中 at noon. then".split()


def prose(rng, count):
    return " ".join(rng.choices(WORDS, k=count))


def corpus(seed=1, count=160):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        parts = [prose(rng, 8), rng.choice(personal(rng)), prose(rng, 8), rng.choice(personal(rng)), prose(rng, 5)]
        texts.append(rng.choice([" ", "\n", " "]).join(parts))
    wrong = [card(rng)[:-1] + "x" for _ in range(20)] + [str(int(card(rng)) // 10 * 10 + 5) for _ in range(40)]
    return texts + [f"{prose(rng, 9)} {x} {prose(rng, 4)}" for x in wrong] + [prose(rng, 60) for _ in range(40)]


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, 1, "k", 2, "s", 3, "n") for i, t in rows], SCHEMA)

    return build


def results(df):
    out = pii.personal_data(df)
    assert out.columns == COLUMNS
    return out.collect()


FUZZ = ["a", "Z", "1", "23", "456", ".", "@", "+", "-", " ", "(", ")", "_", "%", "é", "😀", "\n", "4111111111111111", "10.0.0.1", "a@b.c", " at ", " dot "]


def test_base_equals_the_plain_patterns(make):
    rng = random.Random(3)
    texts = ["".join(rng.choices(FUZZ, k=rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["a@b.c_d@e.f", "a@b.c@d.e.f", "+1 555 (2) ", "+1 5550 1234", "1.2.3.4.5.6.7.8", "000.0256.1.2", "4111-1111 1111-1111", "4111--1111", "1.2.3.4294967296"]
    rows = results(make(list(enumerate(texts))))
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_spans == written(want), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in pii.KINDS]
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))


def test_proposals_equal_the_wide_patterns_and_selection_equals_brute_force(make):
    texts = corpus() + [f"write to me at u7 at mail3 dot example dot com or {card(random.Random(i))[:8]}" for i in range(5)]
    docs = make(list(enumerate(texts)))
    found = pii.spans(docs)
    rows = found.select("*", *pii.features(found.kind, found.found, found.before, found.after)).collect()
    want = {(i, k, m.start(), m.end()) for i, t in enumerate(texts) for k, p in pii.WIDE.items() for m in re.finditer(p, t)}
    assert {(r.doc_id, r.kind, r.start, r.finish) for r in rows if not r.base} == want
    assert all(texts[r.doc_id][r.start : r.finish] == r.found for r in rows)
    model = pii.fit(found)
    assert set(model) == set(pii.KINDS)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    expected = {}
    for i, own in by_doc.items():
        islands = []
        for r in sorted(own, key=lambda r: (r.start, r.finish)):
            if islands and r.start < max(x.finish for x in islands[-1]):
                islands[-1].append(r)
            else:
                islands.append([r])
        kept = []
        for island in islands:
            known = [r for r in island if r.base]
            above = [(pii.total(model[r.kind][0], [r[f] for f in pii.FEATURES]) - model[r.kind][1], -r.start, r.finish, r) for r in island if not r.base]
            above = [x for x in above if x[0] >= 0]
            kept += known or [x[3] for x in sorted(above, key=lambda x: x[:3])[-1:]]
        expected[i] = written({(r.kind, r.start, r.finish) for r in kept})
    got = {r.doc_id: r.spans for r in results(docs)}
    assert got == {i: expected.get(i, "") for i in range(len(texts))}


def test_disguised_data_is_found_and_clean_text_is_left_alone(make):
    rng = random.Random(9)
    known = corpus(2, 300)
    hidden, clean = [], [prose(rng, 50) for _ in range(60)] + [f"on {d} we read {n}" for d, n in [("2024-01-15", "3.14"), ("12.05.2024", "1 000 000"), ("1/2/2003", "10 20 30")]]
    for _ in range(15):
        email, ip, number, _ = personal(rng)
        hidden += [email.replace("@", " at ").replace(".", " dot "), email.replace("@", "[at]").replace(".", "[dot]"), ip.replace(".", "[.]")]
        hidden += [".".join(number[i : i + 4] for i in range(0, 16, 4))]
    texts = known + [f"{prose(rng, 6)} é {x} , {prose(rng, 6)}" for x in hidden] + clean
    rows = {r.doc_id: r for r in results(make(list(enumerate(texts))))}
    places = range(len(known), len(known) + len(hidden))
    hits = sum(texts[i].index(x) == int(rows[i].spans.split(":")[1] or 0) for i, x in zip(places, hidden, strict=True) if rows[i].spans)
    assert hits >= 0.9 * len(hidden)
    added = range(len(known) + len(hidden), len(texts))
    assert {texts[i]: rows[i].spans for i in added if rows[i].spans != rows[i].base_spans} == {}


def test_awkward_rows(make, awkward, nothing):
    texts = [None, "", "x", "a@b.co", "a@b.co"]
    rows = [(1, t) for t in texts] + [(None, "a@b.co 10.0.0.1"), (None, None), (2, "1 " * 100_000), (3, "a." * 100_000), (4, "+1" + " " * 100_000), (5, "a@" + "b." * 100_000)]
    got = results(make(rows))
    assert sorted((str(r.doc_id), r.base_spans) for r in got) == sorted((str(i), written(base(t))) for i, t in rows)
    assert len(results(awkward)) == awkward.count()
    assert results(nothing) == []


def test_many_spans_of_one_text(make):
    text = "a@b.co 10.0.0.1 " * 3000
    (row,) = results(make([(1, text)]))
    assert row.base_spans == written(base(text)) and row.n_email == row.n_ip == 3000


def test_redaction(make):
    rows = [(1, "é a@b.co, 10.0.0.1!"), (2, "none"), (3, None), (4, "4111111111111111 +49 30 1234567")]
    docs = make(rows)
    out = {r.doc_id: r.text for r in pii.redacted(docs, pii.personal_data(docs)).collect()}
    assert out == {1: "é [email], [ip]!", 2: "none", 3: None, 4: "[card] [phone]"}


def test_trees_separate_what_they_learn():
    zero = (0,) * (len(pii.FEATURES) - 2)
    patterns = [((a, b, *zero), 9.0 * (a > 1 or b > 2), 9.0 * (a <= 1 and b <= 2)) for a in range(4) for b in range(5)]
    trees = pii.boost(patterns)
    bound = pii.threshold(trees, patterns)
    assert all((pii.total(trees, v) >= bound) == (good > 0) for v, good, _ in patterns)
    assert pii.boost([p for p in patterns if p[1]]) == [] and pii.threshold([], patterns) is None
