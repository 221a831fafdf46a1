from __future__ import annotations

import random

import pytest

from filingframe.llm import line_dedup
from tests_words import words


def brute(docs, min_words):
    """Lines to remove by doc_id: every run of lines of ``min_words`` words that occurred before."""
    seen, gone = {}, {}
    parsed = []
    for d, text in sorted(docs):
        lines = [(i, line.strip(" \t\r\f\v")) for i, line in enumerate((text or "").split("\n"))]
        parsed.append((d, [(i, x, len(x.split())) for i, x in lines if x.split()]))
    for d, lines in parsed:
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(n for _, _, n in lines[a : b + 1]) >= min_words:
                    run = tuple(x for _, x, _ in lines[a : b + 1])
                    if seen.setdefault(run, (d, lines[a][0])) != (d, lines[a][0]):
                        gone.setdefault(d, set()).update(range(lines[a][0], lines[b][0] + 1))
    return gone


@pytest.mark.parametrize("seed", range(4))
def test_every_repeated_run_goes_and_nothing_else(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 9]))) for _ in range(14)] + [""]
    docs = [(d, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for d in range(25)]
    for d in (3, 9, 17):  # longer shared runs
        docs[d] = (d, docs[d][1] + "\n" + docs[1][1] + "\n" + docs[2][1])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in line_dedup.repeated_runs(table, 8).collect():
        got.setdefault(r.doc_id, set()).update(range(r.no_from, r.no_to + 1))
    assert got == brute(docs, 8)


def test_texts_lose_later_runs(make_docs):
    passage = "\n".join(" ".join(f"w{i}{j}" for j in range(20)) for i in range(3))
    short = "all rights reserved"
    docs = make_docs([f"first\n{passage}\n{short}", f"{short}\n{passage} \nlast", passage + "\n" + passage, "nothing"])
    rows = {r.doc_id: r for r in line_dedup.remove_repeated_runs(docs).collect()}
    assert rows[0].text == f"first\n{passage}\n{short}" and rows[0].removed_lines == 0
    assert rows[1].text == f"{short}\nlast" and rows[1].removed_lines == 3 and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "" and rows[2].removed_lines == 6
    assert rows[3].text == "nothing" and rows[3].n_chars == 7


def test_awkward_rows(awkward, nothing):
    out = line_dedup.remove_repeated_runs(awkward)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "removed_lines"] and len(rows) == awkward.count()
    assert [r for r in rows if r.doc_id == 0][0].text is None
    # rows that repeat are one document, copies under another id are not
    assert [bool(r.text) for r in rows if r.doc_id == 5] == [True, True]
    assert [r.text for r in rows if r.doc_id == 6] == [""]
    assert line_dedup.remove_repeated_runs(nothing).count() == 0
    long = [r for r in rows if r.doc_id == 12][0]
    assert len(long.text) > 100_000


def test_columns_that_clash(make_docs):
    run = "\n".join(words(i, 20) for i in range(4))
    plain = make_docs([run, "own line\n" + run])
    docs = plain.selectExpr("*", "1 as _runs", "'x' as removed_lines", "2 as _doc_id", "3 as _text_hash")
    out = line_dedup.remove_repeated_runs(docs)
    assert out.columns == [c for c in docs.columns if c != "removed_lines"] + ["removed_lines"]
    assert {r.doc_id: (r.text, r.removed_lines, r._runs) for r in out.collect()} == {0: (run, 0, 1), 1: ("own line", 4, 1)}
