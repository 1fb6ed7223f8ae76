"""The Merkle manifest against a tree built in one place, with superblocks of few levels."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, n int, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def up(nodes, fan):
    rows = [list(nodes)]
    while len(rows[-1]) > 1:
        rows.append([sha(*rows[-1][i:i + fan]) for i in range(0, len(rows[-1]), fan)])
    return rows


def way(rows, place, fan):
    out = []
    for row in rows[:-1]:
        start = place // fan * fan
        run = row[start:start + fan]
        out.append((run[:place - start], run[place - start + 1:]))
        place //= fan
    return out


def brute(rows, fan):
    """(id, leaf, subroot, root, proof, folded, verified) of each row; every third id is shown in lower case."""
    own = {}
    for i, text, lang, source, n in rows:
        key = b"" if lang is None else b"+" + lang.encode()
        shown = text.lower() if text is not None and i is not None and i % 3 == 0 else text
        own.setdefault(key, []).append((i, sha(*map(field, (i, source, lang, n, text))), sha(*map(field, (i, source, lang, n, shown)))))
    trees = {k: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for k, v in sorted(own.items())}
    built = {k: up([x[1] for x in v], fan) for k, v in trees.items()}
    top = up([r[-1][0] for r in built.values()], fan)
    out = []
    for at, (key, leaves) in enumerate(trees.items()):
        for place, (i, leaf, shown) in enumerate(leaves):
            steps = way(built[key], place, fan) + way(top, at, fan)
            folded = shown
            for left, right in steps:
                folded = sha(*left, folded, *right)
            proof = [x for left, right in steps for x in left + right]
            out.append((i, leaf, built[key][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def manifest(spark, rows, fan, height):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    shown = {"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))}
    leaves = merkle.leaves_of(docs, ("doc_id", "source", "lang", "n_chars", "text"), shown)
    made = merkle.manifest(leaves, fan, height).collect()
    return sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"], r["verified"]) for r in made), key=repr)


def corpus(seed, n, langs):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "", "Abc é", "x" * i, "ONE"]), r.choice(langs), r.choice([None, "s", "ß"]), r.choice([None, i])) for i in range(n)]
    return rows + rows[:3] + [(None, "No id", langs[0], None, None), (None, "No id", langs[0], None, None), (1 << 60, "far", langs[-1], "s", -5)]


@pytest.mark.parametrize("fan, height, langs", [(2, 1, [None, "a", "b", "é", "z"]), (3, 2, ["en"]), (8, 4, ["en", None])])
def test_equals_a_tree_in_one_place(spark, fan, height, langs):
    rows = corpus(fan, 70, langs)
    assert manifest(spark, rows, fan, height) == brute(rows, fan)


def test_lone_leaf(spark):
    (row,) = manifest(spark, [(1, "A", "en", None, 1)], 8, 4)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == [] and row[6]


def test_lone_leaf_beside_others(spark):
    rows = [(1, "A", "fr", None, 1)] + [(k, "b", "en", None, 1) for k in range(2, 12)]
    assert manifest(spark, rows, 2, 2) == brute(rows, 2)


def test_no_rows(spark):
    assert manifest(spark, [], 8, 4) == []


def test_tampering_shows(spark):
    got = manifest(spark, [(k, "Some Text", "en", "s", 9) for k in range(30)], 4, 2)
    assert all(r[6] == (r[0] % 3 != 0) for r in got)
