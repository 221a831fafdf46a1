from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from filingframe.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos long, own string, before string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root of a list of digests, and each one's way up: (digests left, digests right) a level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
            ways[i].append((run[: place % 3], run[place % 3 + 1 :]))
        nodes, at = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], [p // 3 for p in at]
    return nodes[0], ways


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in sources[name]])
    root, over = tree([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, over, strict=True):
        subroot, ways = trees[name]
        for (_, _, digest, row), way in zip(sources[name], ways, strict=True):
            way = way + above
            start = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                start = leaf(row, row[4].replace("\n", ""))
            for left, right in way:
                start = sha(*left, start, *right)
            proof = sha(*(d for left, right in way for d in left + right))
            out.append((row[0], digest, subroot, root, proof, start, start == root))
    return out


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "x", 1, "x", "x") for r in rows], SCHEMA)

    return build


def found(df, levels=merkle.LEVELS):
    out = merkle.verified(merkle.manifest(df, levels))
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), sum(sizes.values()))
    names = [name for name, n in sizes.items() for _ in range(n)]
    return [(i, s, rng.choice(["en", None, ""]), 3, rng.choice(["a\nb", "é\n", "", None, "plain"])) for i, s in zip(ids, names, strict=True)]


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_equals_brute_force(make, levels):
    rows = rows_of({"hot": 60, None: 10, "": 1, "é": 27, "z": 28, "one": 1, "b": 2})
    assert found(make(rows), levels) == sorted(brute(rows), key=str)


def test_awkward_rows(make, awkward):
    rows = [(None, None, None, None, None), (1, "a", "en", 1, ""), (1, "a", "en", 1, ""), (1, "a", "en", 2, "\n"), (None, "a", "en", 1, "x\ny")]
    rows += [(7, "a", "en", 5, "long\n" * 200_000)]
    assert found(make(rows)) == sorted(brute(rows), key=str)
    given = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in awkward.collect()]
    assert found(awkward) == sorted(brute(given), key=str)


def test_single_row_and_empty_table(make):
    row = (4, "s", "en", 1, "t")
    assert found(make([row])) == brute([row])
    assert found(make([row]).filter("false")) == []


def test_appends_keep_witnesses_of_every_prefix():
    for n in range(1, 30):
        digests = [sha(str(i)) for i in range(n)]
        tree_ = merkle.Appends(merkle.height(n))
        for d in digests:
            tree_.append(d)
        root, ways = tree(digests)
        assert tree_.close() == root
        assert [list(zip(b, a, strict=True)) for b, a in zip(tree_.before, tree_.after, strict=True)] == [
            [("".join(left), "".join(right)) for left, right in way] for way in ways
        ]


def test_blocks_spread_a_hot_source(make):
    rows = rows_of({"hot": 400, "cold": 5})
    placed = merkle._placed(make(rows).selectExpr("source as grp", "doc_id as key", "sha2(cast(doc_id as string), 256) as node"))
    got = sorted((r.grp, r.pos, r.n) for r in placed.collect())
    assert got == [("cold", i, 5) for i in range(5)] + [("hot", i, 400) for i in range(400)]


def test_sql_twin(spark, make):
    import duckdb

    rows = rows_of({"hot": 40, None: 9, "é": 3, "z": 1}) + [(None, "z", None, None, "a\nb")]
    con = duckdb.connect()
    con.register("documents", make(rows).select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    assert sorted(con.execute(merkle.SQL).fetchall(), key=str) == sorted(brute(rows), key=str)
