"""Line dedup against a comparison of every two lines."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark.llm import linedup


def shingles(line):
    words = line.split()
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def brute(docs):
    """By (doc, line): class text, other classes that match, removed."""
    lines = [((d is None, d or 0, k), " ".join(x.split())) for d, t in docs for k, x in enumerate((t or "").split("\n"))]
    sets = {t: shingles(t) for _, t in lines if t}
    first = {}
    for p, t in lines:
        if t:
            first[t] = min(p, first.get(t, p))
    near = {a: [b for b in sets if b != a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9] for a in sets}
    return {p: (t, len(near[t]) if t else 0, bool(t) and min([first[t], *(first[b] for b in near[t])]) < p) for p, t in lines}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 3)
    base = [[word() for _ in range(r.choice([1, 3, 5, 6, 9, 15, 30, 60, 61, 62]))] for _ in range(40)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(r.randint(0, 8)):
            line = list(r.choice(base))
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                at = r.randrange(max(1, len(line)))
                line[at:at + 1] = r.choice([[word()], [], [*line[at:at + 1], word()]])
            lines.append(r.choice([" ", " ", "  ", "\t"]).join(line))
        docs.append((d, "\n".join(lines)))
    return docs + [(None, " ".join(base[0])), (100, None), (101, ""), (102, "\n \n")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, seed):
    docs = corpus(seed)
    table = spark.createDataFrame([(*x, 0, "c") for x in docs], "doc_id long, text string, row int, class string")
    want = brute(docs)
    got = {(x["doc_id"] is None, x["doc_id"] or 0, x["line_no"]): x for x in linedup.match_lines(table).collect()}
    assert set(got) == set(want)
    classes = {}
    for p, (text, n, removed) in want.items():
        assert (got[p]["n_links"], got[p]["removed"]) == (n, removed), (p, text)
        assert (got[p]["class_id"] is None) == (text == "")
        assert classes.setdefault(text, got[p]["class_id"]) == got[p]["class_id"]
    assert sum(w[2] for w in want.values()) > 50 and any(w[1] for w in want.values())
    left = linedup.remove_repeats(table)
    assert left.columns == table.columns
    kept = {x["doc_id"]: x["text"] for x in left.collect()}
    for d, t in docs:
        assert kept[d] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not want[(d is None, d or 0, k)][2]))


def test_odd_tables(spark):
    table = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a  b c\nd " + "x " * 50_000)], "doc_id long, text string")
    assert sorted((x["doc_id"], x["line_no"], x["removed"]) for x in linedup.match_lines(table).collect()) == [(1, 0, False), (1, 0, False), (2, 0, True), (2, 1, False)]
    assert sorted(x["text"] for x in linedup.remove_repeats(table).collect()) == ["a b c", "a b c", "d " + "x " * 50_000]
    assert linedup.match_lines(table.limit(0)).count() == 0 and linedup.remove_repeats(table.limit(0)).count() == 0


def test_clashing_names(spark):
    table = spark.createDataFrame([(1, "a b\na b", "mine", 5, 6), (2, "a b", "yours", 7, 8)], "doc_id long, text string, __row string, __gone int, class int")
    assert sorted(map(tuple, linedup.remove_repeats(table).collect())) == [(1, "a b", "mine", 5, 6), (2, "", "yours", 7, 8)]


def test_rarities(spark):
    lines = linedup.lines_of(spark.createDataFrame(corpus(3), "doc_id long, text string"), "doc_id", "text")
    words = lines.where("worded").select(F.split("line", " ").alias("w")).select(F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    hashes = words.select(F.explode(linedup._places(F.col("w"), 5)).alias("at"), "w").select(linedup._hash(F.col("w"), F.col("at"), 5))
    want = Counter(h & (linedup.BUCKETS - 1) for h, in hashes.collect())
    got = spark.range(1).select(linedup._rarities(lines, 5)).first()[0]
    assert [x >> 55 for x in got] == [math.floor(4 * math.log2(want[b] + 1)) for b in range(linedup.BUCKETS)] and max(want.values()) > 5
    # A row of the aggregation for each bucket is more than its hash table in generated code takes (65,536).
    assert linedup.BUCKETS // linedup.LANES < 1 << 16


def test_shared_prefixes(spark, monkeypatch):
    # The join of prefixes gets the shingles of two classes or more, and each row of those.
    lines = linedup.lines_of(spark.createDataFrame(corpus(4), "doc_id long, text string"), "doc_id", "text")
    written, stash = [], linedup.stash
    monkeypatch.setattr(linedup, "stash", lambda df, name: written.append(stash(df, name)) or written[-1])
    linedup.links(lines)
    classes = {}
    for row in linedup._prefixes(lines, 5, 0.8).collect():
        classes.setdefault(row["token"], []).append(tuple(row))
    joined, = (df for df in written if "token" in df.columns)
    want = [row for rows in classes.values() if len({r[1] for r in rows}) > 1 for row in rows]
    assert sorted(map(tuple, joined.collect())) == sorted(want) and 0 < len(want) < sum(map(len, classes.values()))


def test_white_space(spark):
    texts = ["a b\nc", "a\vb", " a\rb ", "a\f\tb\n \v", "a  b", "a b ", "a\u00a0b"]
    got = linedup.match_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    classes = {(x["doc_id"], x["line_no"]): x["class_id"] for x in got}
    assert len({classes[d, 0] for d in range(6)}) == 1 and len({classes[d, 0] for d in (0, 6)} | {classes[0, 1]}) == 3
    assert classes[3, 1] is None and len(classes) == 9
