"""SimHash: fingerprints and components against brute force, with blocks whole and cut."""

import random
import re

import pytest
import xxhash

from lexspark.llm import simhash
from lexspark.llm.components import components

U64 = (1 << 64) - 1


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=3):
    own = list(range(len(fps)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                own[b] = a
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clusters(seed):
    r = random.Random(seed)
    out = {0, U64, 1, 7}
    for _ in range(12):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 5, 60])):
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 7])
def test_links(spark, chunk, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    fps = clusters(1)
    edges = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 3, chunk)
    roots = {r["node"] & U64: r["root"] for r in components(edges).collect()}
    want = brute_components(fps)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(f)
    got = {}
    for f in fps:
        got.setdefault(roots.get(f, signed(f)), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))
    assert edges.count() <= 20 * len(fps)


def test_fingerprints(monkeypatch):
    r = random.Random(2)
    texts = [None, "", " \n", "One", "one two", "one two three", "É A é a\x1c b", "a b c " * 50] + [" ".join(r.choice(["The", "of", "á", "x"]) for _ in range(r.randint(0, 60))) for _ in range(60)]
    for step in (simhash.STEP, 4):
        monkeypatch.setattr(simhash, "STEP", step)
        for t in texts:
            assert simhash.fingerprint(t) & U64 == brute_fingerprint(t)


def test_near_duplicates(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefghijklmnop") * r.randint(1, 4) for _ in range(80)) for _ in range(12)]
    texts = [(k * 3 + c, t if c == 0 else t.replace(t.split()[5], "changed", 1) if c == 1 else t) for k, t in enumerate(base) for c in range(3)]
    rows = [(i, t) for i, t in texts] + [(100, None), (101, ""), (None, base[0]), (7, base[3]), (7, base[3])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, row int")
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components(fps)
    least = {w: min(i for (i, _), v in zip(rows, want) if v == w and i is not None) for w in set(want)}
    got = sorted((x["doc_id"] is None, x["doc_id"], x["fingerprint"], x["component_id"]) for x in simhash.near_duplicates(docs).collect())
    assert got == sorted((i is None, i, f"{f:016x}", least[w]) for (i, _), f, w in zip(rows, fps, want))
    kept = [x["doc_id"] for x in simhash.keep_one(docs).collect()]
    assert sorted(set(kept)) == sorted(set(least.values()))
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(5, 5), (None, 3), (900, 901), (901, 900)], "a long, b long"))
    got = {(r["node"], r["root"]) for r in components(edges).collect()}
    assert got == {(k, 0) for k in range(301)} | {(900, 900), (901, 900)}
