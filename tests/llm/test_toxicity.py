from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingframe.llm import common, toxicity
from tests_words import words

BAD = ["grumblefish", "snorkwaffle"]


def obfuscated(word: str, seed: int) -> str:
    rng = random.Random(seed)
    if seed % 3 == 0:
        return " ".join(word)
    if seed % 3 == 1:
        return word[:3] + word[3] * 4 + word[4:]
    swap = {"e": "3", "o": "0", "a": "@", "s": "$", "i": "1"}
    return "".join(swap.get(c, c) if rng.random() < 0.7 else c for c in word)


@pytest.fixture(scope="module")
def corpus(spark, make_docs):
    texts, toxic = [], []
    for i in range(240):
        own = words(100 + i, 30).translate(str.maketrans("", "", "0123456789"))
        bad = i % 4 == 0
        if bad:
            own += " " + BAD[i % 8 // 4] + " " + words(i, 3).translate(str.maketrans("", "", "0123456789"))
        texts.append(own)
        toxic.append((i, 0, int(bad)))
    return make_docs(texts), spark.createDataFrame(toxic, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_held_out_labels(corpus, model):
    docs, labels = corpus
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(common.held_out()).collect()
    assert len(rows) > 30 and all((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in rows)


def test_obfuscated_words_are_restored(make_docs, model):
    docs = make_docs([f"alpha beta {obfuscated(BAD[i % 2], i)} gamma" for i in range(12)] + ["alpha beta 1234 gamma"])
    rows = toxicity.score(docs, model).orderBy("doc_id").collect()
    assert all(r.score >= toxicity.THRESHOLD for r in rows[:12]) and rows[12].score < toxicity.THRESHOLD


def brute(lattices, characters):
    """The cheapest path by listing all of them."""
    best = None
    for extra, steps in lattices:
        for path in itertools.product(*steps):
            text, cost, state = "".join(m for m, _ in path), extra + sum(x for _, x in path), (0, 0, 0)
            for letter in text + " ":
                code = 0 if letter == " " else ord(letter) - 96
                if code or any(state):
                    cost += float(characters[(*state, code)])
                state = (*state[1:], code) if code else (0, 0, 0)
            if best is None or cost < best[0] - 1e-6:
                best = (cost, text)
    return best


CHUNKS = ["gr0mbl3", "a1pha", "b3t@", "gaaamma", "d.e.l.t.a", "z3tt@", "1337", "k4pp4!", "0o0", "aallpphhaa", "g\u00b7a\u00b7m\u00b7m\u00b7a", "bbbeeetttaaa"]


def test_viterbi_finds_the_cheapest_path(model):
    costs = model.characters.ravel().tolist()
    for chunk in CHUNKS:
        want = brute(toxicity.lattices(chunk), model.characters)
        found = min(extra + toxicity.cheapest(steps, costs)[0] for extra, steps in toxicity.lattices(chunk))
        assert found == pytest.approx(want[0], abs=1e-4)
        assert toxicity.decode(chunk, costs) == want[1]
    for run in ["a l p h a", "a  b\ne_t a", "b e t a . a l"]:
        steps = toxicity.spelt_steps(run)
        assert toxicity.cheapest(steps, costs)[0] == pytest.approx(brute([(0.0, steps)], model.characters)[0], abs=1e-4)


def test_plain_words_pass_unchanged(model):
    costs = model.characters.ravel().tolist()
    for word in ["alpha", "kapi", "\u00e9t\u00e9", "\u4e2d\u6587", "123", "\u4e2d\u4e2d"]:
        assert toxicity.restore(word, costs) in (word, toxicity.fold(word))


DISGUISES = {
    "doubled": lambda w: "".join(c * 2 for c in w),
    "tripled": lambda w: "".join(c * 3 for c in w),
    "dots": ".".join,
    "middle dots": "\u00b7".join,
    "bullets": "\u2022".join,
    "eight dashes": ("-" * 8).join,
    "blanks": " ".join,
    "two blanks": "  ".join,
    "line ends": "\n".join,
    "tabs and underscores": lambda w: "\t".join(w[:4]) + "_" + "_".join(w[4:]),
    "after a short word": lambda w: "a " + " ".join(w),
    "two words": lambda w: " ".join(w) + " " + " ".join(w),
    "stretched 45 times": lambda w: w[:2] + w[2] * 45 + w[3:],
    "stretched everywhere": lambda w: "".join(c * 45 for c in w),
    "long tail": lambda w: w + w[-1] * 300,
    "capitals and accents": lambda w: w.upper().replace("U", "\u00dc").replace("O", "\u00d6"),
    "zero width": "\u200b".join,
}


@pytest.mark.parametrize("bad", BAD)
def test_every_disguise_is_restored(make_docs, model, bad):
    docs = make_docs([f"alpha beta {disguise(bad)} gamma" for disguise in DISGUISES.values()])
    rows = toxicity.score(docs, model).orderBy("doc_id").collect()
    assert [name for name, r in zip(DISGUISES, rows, strict=True) if r.score < toxicity.THRESHOLD] == []


def test_whole_score_equals_brute_force(make_docs, model):
    texts = [f"{bad} z3ta" for bad in ("alpha", *BAD)] + [" ".join(CHUNKS), "a l p h a", "", "v1 g r u", "snorkw@ffle. 12 (be7a)", "d e l t a\nx"]
    for row in toxicity.score(make_docs(texts), model).collect():
        text, found = texts[row.doc_id], set()
        for run in re.findall(r"(?<!\S)[^\s_](?:[\s_]+[^\s_]){2,}(?!\S)", text):
            found.update(brute([(0.0, toxicity.spelt_steps(run))], model.characters)[1].split())
        for chunk in text.split():
            word = toxicity._EDGE.sub("", toxicity._EDGE.sub("", toxicity.fold(chunk)))
            plain = word.isdigit() or sum(c in toxicity.IMITATED or "a" <= c <= "z" for c in word) < 3
            found.add(word if plain else brute(toxicity.lattices(word), model.characters)[1])
        evidence = {f for w in found for f in toxicity.features(w)} & set(model.words)
        assert set(row.evidence) == evidence
        logit = model.bias + sum(model.words[f] for f in evidence)
        assert row.score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_character_model_is_a_distribution():
    model = toxicity.character_model(np.array([5, 27 * 3 + 2]), np.array([7, 9]))
    assert np.allclose(np.exp(-model).sum(-1), 1, atol=1e-4)
    counts = np.bincount(toxicity._contexts("ab c"), minlength=27**4)
    at = lambda *c: counts[((c[0] * 27 + c[1]) * 27 + c[2]) * 27 + c[3]]
    assert (at(0, 0, 0, 1), at(0, 0, 1, 2), at(0, 1, 2, 0), at(0, 0, 0, 3), at(0, 0, 3, 0)) == (1, 1, 1, 1, 1)
    assert counts.sum() == 5


def test_copies_give_no_weight_to_what_they_share():
    found = [[0] for _ in range(200)] + [[0, 1, 2]] * 30 + [[] for _ in range(2000)]
    toxic = np.array([1.0] * 230 + [0.0] * 2000)
    weights, bias = toxicity.fit_weights(found, toxic, 3)
    assert weights[0] > 5 * max(weights[1], weights[2]) and weights[0] + bias > 0 > bias


def test_awkward_rows(spark, corpus, awkward, nothing, model):
    out = toxicity.score(awkward, model)
    assert out.count() == awkward.count() and out.filter("score between 0 and 1").count() == awkward.count()
    assert toxicity.score(nothing, model).count() == 0
    no_labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    bare = toxicity.fit(nothing, no_labels)
    assert bare.words == {} and toxicity.score(awkward, bare).agg(F.max("score")).first()[0] < toxicity.THRESHOLD
    kept = toxicity.keep_clean(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_labels_of_the_held_out_fold_are_never_learnt(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(common.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped).words == toxicity.fit(docs, labels).words


def test_copies_of_a_long_text_push_no_word_out(spark, make_docs):
    """A third of the labelled rows are one toxic text with more words and stems than were once learnt."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(1000))
    texts, toxic = [], []
    for i in range(120):
        own = words(100 + i, 30).translate(str.maketrans("", "", "0123456789"))
        texts += [own + (f" {BAD[0]}" if i % 3 == 0 else "")]
        toxic.append((i, 0, int(i % 3 == 0)))
    texts += [long] * 60
    toxic += [(120 + i, 0, 1) for i in range(60)]
    model = toxicity.fit(make_docs(texts), spark.createDataFrame(toxic, "doc_id long, quality int, toxic int"))
    assert BAD[0] in model.words and not set(long.split()) & set(model.words)
