"""Quality ledger against a brute-force version; policies and ablations from stored bits."""

import random
import re

from lexspark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = [i for i, g in enumerate(grams) if grams.count(g) > 1]
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len({j for i in twice for j in (i, i + 1, i + 2)}))


def test_measures(spark):
    r = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", "a a", "a a a", "a a a a", "\x1c b\x85 é\n\n🙂 #*", "x " * 3000]
    texts += ["".join(r.choice(["the", "of", "a", " ", " ", "\n", "#", "é", "\t", "\r\n"]) for _ in range(r.randint(0, 120))) for _ in range(300)]
    table = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, n_words int, failed int")
    got = {x["doc_id"]: x for x in quality.ledger(table).collect()}
    for k, text in enumerate(texts):
        want = brute(text)
        assert tuple(got[k][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, text
        assert bool(got[k]["failed"] & 3) == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert quality.ledger(table.limit(0)).count() == 0
    assert quality.ledger(table.unionAll(table)).count() == 2 * len(texts)


def test_ablations(spark):
    masks = [0, 0, 1, 2, 3, 4, 64, 65]
    ledger = spark.createDataFrame([(m,) for m in masks], "failed long")
    for version, names in quality.POLICIES.items():
        bits = quality.mask(version)
        for row in quality.ablations(ledger, version).collect():
            bit = 1 << [x.name for x in quality.RULES].index(row["rule"])
            assert row["n_failed"] == sum(bool(m & bit) for m in masks)
            assert row["n_only"] == sum(m & bits == bit for m in masks)
            assert row["n_kept"] == sum(m & bits == 0 for m in masks)
    assert {r["n_kept"] for r in quality.ablations(ledger.limit(0), "v2").collect()} == {0}
