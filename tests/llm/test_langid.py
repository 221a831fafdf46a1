from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingframe.llm import common, langid

STEMS = {
    "aa": ["tha", "ing", "ble", "ent", "sho", "wer"],
    "bb": ["eau", "oui", "çon", "éle", "que", "tre"],
    "cc": ["sch", "ung", "ßer", "ich", "zu", "tz"],
}


def text(lang: str, seed: int, n: int = 40) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(make_docs):
    langs = [list(STEMS)[i % 3] for i in range(120)]
    return make_docs([text(lang, i) for i, lang in enumerate(langs)], langs)


@pytest.fixture(scope="module")
def net(labelled):
    return langid.fit(labelled)


def test_held_out_accuracy(labelled, net):
    found = langid.identify(labelled, net).join(labelled.select("doc_id", "lang"), "doc_id").filter(common.held_out())
    rows = found.collect()
    assert len(rows) > 15 and all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in rows)


def test_backpropagation_matches_differences():
    net = langid.new_network(["a", "b", "c"], hidden=3, seed=1)
    rng = np.random.default_rng(0)
    rows, label, weight = rng.integers(0, 256, (4, 5), np.uint8), np.array([0, 2, 1, 1]), np.array([1.0, 2, 0.5, 1])

    def loss() -> float:
        p = langid.positions(net, rows)
        own = -np.log(p[np.arange(4), :, label])
        return float((own.mean(1) * weight).sum() / weight.sum())

    for part, gradient in zip(net.parts(), langid._gradients(net, rows, label, weight), strict=True):
        for at in [np.unravel_index(np.abs(gradient).argmax(), part.shape)]:
            before = part[at]
            part[at] = before + 1e-2
            up = loss()
            part[at] = before - 1e-2
            down = loss()
            part[at] = before
            assert abs((up - down) / 2e-2 - gradient[at]) < 2e-3


def test_remembered_sums_are_those_of_every_position(net):
    whole = ("  ".join(text("aa", 1, 5).split()) + "\nTHA " + "q" * 100).encode()
    sums, n = np.zeros(3), 0
    for word in langid.lowered(whole).split():
        for at in range(0, len(word), langid.SEGMENT):
            piece = np.frombuffer(word[at : at + langid.SEGMENT], np.uint8)[None]
            sums += langid.positions(net, piece)[0].sum(0)
            n += piece.shape[1]
    for remembered in (0, 1000):
        labeller = langid.Labeller(net, remembered)
        for _ in range(3):
            p = labeller.distributions([whole, None, b"other words", b" ", whole])
            assert np.allclose(p[[0, 4]], sums / n, atol=1e-5) and np.allclose(p[[1, 3]], 1 / 3)


def test_awkward_rows(awkward, nothing, net):
    out = langid.identify(awkward, net)
    assert out.columns == ["doc_id", "lang_pred", "score"] and out.count() == awkward.count()
    by_text = awkward.filter("text is null or trim(text) = ''").count()
    assert out.filter("lang_pred = 'und' and score = 0").count() >= by_text
    assert langid.identify(nothing, net).count() == 0
    assert langid.fit(nothing) is None
    assert {r.lang_pred for r in langid.identify(awkward, None).collect()} == {"und"}


def test_labels_are_never_an_input(labelled, net):
    other = labelled.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("x"))
    a = {r.doc_id: r.score for r in langid.identify(labelled, net).collect()}
    assert a == {r.doc_id: r.score for r in langid.identify(other, net).collect()}
    held = labelled.withColumn("lang", F.when(common.held_out(), "zz").otherwise(F.col("lang")))
    assert langid.fit(held).langs == ["aa", "bb", "cc"]


def test_only_undetermined_rows_go(awkward, net):
    kept = langid.keep_determined(awkward, net, 0.25)
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.filter(F.col("text").rlike(r"\p{L}")).count()


def test_the_network_rejects_gibberish_only(make_docs):
    stems = STEMS | {"dd": ["kko", "yyt", "ään", "öll", "isu", "vat"]}
    langs = list(stems)

    def own(lang, seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))

    texts = [own(langs[i % 4], i, 40) for i in range(120)]
    both = [own(a, 1, 60) + " " + own(b, 2, 60) for i, a in enumerate(langs) for b in langs[i + 1 :]]
    rng = random.Random(5)
    letters = sorted("".join(s for lang in langs for s in stems[lang]))
    gibberish = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(600)) for _ in range(4)]
    labelled = make_docs(texts, [langs[i % 4] for i in range(120)])
    net = langid.fit(labelled)
    least = langid.least_score(labelled, net)
    docs = make_docs(texts + both + gibberish)
    kept = {r.doc_id for r in langid.keep_determined(docs, net, least).collect()}
    assert 0.25 < least < 0.5 and kept == set(range(len(texts) + len(both)))
    assert langid.least_score(labelled, None) == 0


def test_a_language_without_blanks_and_capitals_beyond_ascii(make_docs):
    """Sentences of one long run of bytes are learned, and capitals are read as what they are."""
    rng = random.Random(2)
    han = [chr(0x4E00 + i) for i in range(40)]
    kyrillic = ["при", "ого", "ста", "ний", "ель", "щая"]
    texts, langs = [], []
    for i in range(90):
        texts += ["".join(rng.choices(han, k=60)), " ".join("".join(rng.choices(kyrillic, k=2)) for _ in range(30)), text("aa", i)]
        langs += ["zh", "ru", "en"]
    net = langid.fit(make_docs(texts, langs))
    assert net.langs == ["en", "ru", "zh"]
    asked = [texts[0], texts[1].upper(), texts[2].upper(), "ПРИЕЛЬ ЩАЯСТА", "".join(han[5:25])]
    rows = langid.identify(make_docs(asked), net).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["zh", "ru", "en", "ru", "zh"]


def test_a_rare_language_among_thirty_is_learned(make_docs, monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 1)
    rng = random.Random(8)
    texts, langs = [], []
    for number in range(30):
        own = "abcdefghijklmnopqrstuvwxyz"[number % 26] + "xyz"[number % 3]
        for i in range(1 if number == 29 else 12):
            texts.append(" ".join(own + "".join(rng.choices("abcdef", k=4)) for _ in range(40 + i)))
            langs.append(f"l{number:02d}")
    docs = make_docs([(4 * i, t) for i, t in enumerate(texts)], langs)
    labelled = docs.filter(~common.held_out())
    want = sorted({r.lang for r in labelled.collect()})
    found = langid.training_segments(docs, words=50)
    assert sorted({lang for lang, _, _ in found}) == want and len(want) >= 29
    assert max(sum(lang == x for x, _, _ in found) for lang in want) <= 50


def test_copies_of_a_text_are_sampled_once(make_docs):
    docs = make_docs([(4 * i, text("aa", 1)) for i in range(300)] + [(5000, text("aa", 2))], ["aa"] * 301)
    drawn = langid.learned_documents(docs).collect()
    assert len(drawn) == len({r.text for r in drawn}) <= 2 and drawn


def test_predictions_equal_brute_force(labelled, net):
    """Every byte of every piece read by itself."""
    for r in langid.identify(labelled, net).limit(20).join(labelled.select("doc_id", "text"), "doc_id").collect():
        words = [w for w in langid.lowered(r.text.encode()).split()]
        own = sum(langid.positions(net, np.frombuffer(p, np.uint8)[None])[0].sum(0) for w in words for p in langid.pieces(w))
        share = own / own.sum()
        assert net.langs[int(share.argmax())] == r.lang_pred and abs(share.max() - r.score) < 1e-5


def test_the_limit_is_learned_from_every_labelled_document(labelled, net, monkeypatch):
    """No sample: the exact quantiles of all correctly labelled texts outside the held-out fold."""

    def sample(*_):
        raise AssertionError("a sample was drawn")

    monkeypatch.setattr(langid, "learned_documents", sample)
    rows = labelled.filter(~common.held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = {(r.doc_id, r.lang): r.text for r in rows.collect()}
    scores = {}
    for r in langid.identify(rows, net).collect():
        if (r.doc_id, r.lang_pred) in known:
            scores[known[r.doc_id, r.lang_pred], r.lang_pred] = r.score
    values, even = list(scores.values()), 1 / len(net.langs)
    usual = min(np.quantile(values, langid.LOW), np.median(values) / 2)
    want = (usual + even) / 2 if usual > even else 0.0
    assert values and abs(langid.least_score(labelled, net) - want) < 1e-6
