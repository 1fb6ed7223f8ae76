"""Decontamination against alignment with every item at every place."""

import random

import pytest

from lexspark.llm import decontaminate as d

VOCABULARY = [f"w{k}" for k in range(60)]


def brute(docs, items):
    out = set()
    for doc, text in docs:
        tokens = d.words(text or "")
        for item, body in items:
            own = d.words(body or "")
            if len(own) >= d.LEAST_WORDS and tokens and d.align(own, tokens)[0] >= d.SCORE * d.MATCH * len(own):
                out.add((doc, item))
    return out


def slow_align(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (d.MATCH if a[i - 1] == b[j - 1] else d.MISMATCH), table[i - 1][j] + d.GAP, table[i][j - 1] + d.GAP)
    return max(map(max, table))


def edited(r, tokens, share):
    out = []
    for w in tokens:
        x = r.random()
        if x < share / 3:
            continue
        out.append(r.choice(VOCABULARY) if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append(r.choice(VOCABULARY))
    return out


def cases(seed):
    r = random.Random(seed)
    items = [(k, " ".join(r.choice(VOCABULARY) for _ in range(r.choice([8, 15, 40, 100])))) for k in range(12)] + [(50, "too short"), (51, None), (52, "")]
    items.append((53, items[0][1]))
    docs = [(0, None), (1, "")]
    for k in range(2, 120):
        tokens = [r.choice(VOCABULARY) for _ in range(r.randint(0, 120))]
        for _ in range(r.choice([0, 0, 1, 2])):
            at = r.randint(0, len(tokens))
            tokens[at:at] = edited(r, r.choice(items[:12])[1].split(), r.choice([0, 0.05, 0.1]))
        docs.append((k, " ".join(tokens).upper() + "."))
    return docs, items


def test_align():
    r = random.Random(1)
    for _ in range(150):
        a, b = ([r.choice("abcd") for _ in range(r.randint(1, 15))] for _ in range(2))
        score, first, last = d.align(a, b)
        assert score == slow_align(a, b) and (score == 0 or slow_align(a, b[first:last]) == score)


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 400])
def test_matches(spark, block, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    docs, items = cases(block)
    want = brute(docs, items)
    table = spark.createDataFrame([(*x, 0.5) for x in docs], "doc_id long, text string, score double")
    benchmark = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string")
    rows = d.matches(table, benchmark).collect()
    # A copy is found by a seed it left whole; one edited in every n-gram is beyond the method.
    found = {(x["doc_id"], x["item_id"]) for x in rows}
    assert found <= want and len(want) > 20 and len(want - found) <= len(want) // 50
    for x in rows:
        text = d.words(docs[x["doc_id"]][1])[x["first_word"]:x["last_word"]]
        assert d.align(d.words(dict(items)[x["item_id"]]), text)[0] == round(x["score"] * d.MATCH * len(d.words(dict(items)[x["item_id"]])))
    left = d.clean(table, benchmark)
    assert {x["doc_id"] for x in left.collect()} == {k for k, _ in docs} - {k for k, _ in found} and left.columns == table.columns


def test_odd_tables(spark):
    long = " ".join(f"x{k}" for k in range(1000))
    docs = spark.createDataFrame([(1, "a " * 100_000 + long), (None, long), (None, long), (2, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(7, long)], "item_id long, text string")
    rows = d.matches(docs, items).collect()
    assert {x["doc_id"] for x in rows} == {1, None} and {x["item_word"] for x in rows} == {k * 1000 // 8 for k in range(8)}
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        assert d.matches(a, b).count() == 0 and d.clean(a, b).count() == a.count()


def found_in(items, text):
    index = d.build(items)
    return {index.items[n] for n, *_ in d.copies(index, text)}


def test_regular_edits():
    # Every copy that scores enough and has an intact n-gram is found, whatever the rarity of those that edits have broken.
    r, seen = random.Random(4), 0
    for n in (31, 32, 40, 60, 100, 128):
        for step in (4, 5, 7):
            for shift in range(step):
                item = [f"i{k}" for k in range(n)]
                copy = [f"x{r.random()}" if k % step == shift else w for k, w in enumerate(item)]
                text = [r.choice(VOCABULARY) for _ in range(50)] + copy + [r.choice(VOCABULARY) for _ in range(50)]
                if d.align(item, copy)[0] >= d.SCORE * d.MATCH * n:
                    seen += 1
                    for counts in ({}, {g: 9 for g in zip(copy, copy[1:], copy[2:])}):
                        index = d.build([(1, " ".join(item))])
                        index.frequency = counts
                        assert {index.items[k] for k, *_ in d.copies(index, " ".join(text).replace("0.", ""))} == {1}, (n, step, shift)
    assert seen > 60


def test_regular_edits_in_a_table(spark):
    item = [f"i{k}" for k in range(60)]
    copy = ["x" if k % 4 == 3 else w for k, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(copy)), (2, "x y z")], "doc_id long, text string")
    assert [x["doc_id"] for x in d.matches(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()] == [1]


def test_two_copies_side_by_side():
    item = [f"i{k}" for k in range(40)]
    first = ["x" if k % 6 == 3 else w for k, w in enumerate(item)]
    index = d.build([(1, " ".join(item))])
    assert sorted(x[2:] for x in d.copies(index, " ".join([*first, *item]))) == [(0, 39), (40, 80)]


def test_passages_lie_anywhere():
    item = [f"i{k}" for k in range(400)]
    noise = [f"x{k}" for k in range(70)]
    for size in (60, 75, 110):
        for start in range(0, 400 - size + 1):
            assert found_in([(1, " ".join(item))], " ".join([*noise, *item[start:start + size], *noise])) == {1}, (size, start)
    # Parts that overlap tell one passage once.
    index = d.build([(1, " ".join(item)), (2, " ".join(item))])
    found = [(index.items[n], index.offsets[n]) for n, *_ in d.copies(index, " ".join([*noise, *item, *noise]))]
    assert sorted(found) == [(i, k) for i in (1, 2) for k in (0, 100, 200, 300)]


def test_words_put_in():
    for n in (15, 60, 128):
        item = [f"i{k}" for k in range(n)]
        for at in range(4, n - 3):
            for more in (n // 2, int(0.8 * n)):
                text = [*item[:at], *(f"x{k}" for k in range(more)), *item[at:]]
                want = d.align(item, text)[0] >= d.SCORE * d.MATCH * n
                assert want and found_in([(1, " ".join(item))], " ".join(["y"] * 50 + text + ["y"] * 50)) == {1}, (n, at, more)


def test_short_items_and_scripts_without_spaces():
    items = [(1, "What is the capital?"), (2, "Paris"), (3, "\u4eca\u65e5\u306f\u3068\u3066\u3082\u3044\u3044\u5929\u6c17\u3067\u3059\u306d\u3002\u6563\u6b69\u306b\u884c\u304d\u307e\u3057\u3087\u3046\u3002"), (4, "\u4eca\u65e5"), (5, " . "), (6, "what is the CAPITAL")]
    assert d.words("Ab c\u4eca\u65e5\u3002d_1\u3044") == ["ab", "c", "\u4eca", "\u65e5", "d_1", "\u3044"]
    assert found_in(items, "He asked: what is -- the capital; of France") == {1, 6}
    assert found_in(items, "what is the big capital of parish") == set()
    assert found_in(items, "paris paris") == {2} and len(list(d.copies(d.build(items), "paris paris"))) == 2
    # One other character among 20.
    copied = items[2][1].replace("\u6563", "\u8d70")
    assert found_in(items, "x" + copied + "y") == {3, 4} and found_in(items, "") == set()


def test_short_items_in_a_table(spark):
    docs = spark.createDataFrame([(1, "say: two plus two!"), (2, "two plus three")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Two plus two")], "item_id long, text string")
    assert [(x["doc_id"], x["item_id"], x["first_word"], x["last_word"]) for x in d.matches(docs, items).collect()] == [(1, 7, 1, 4)]
    assert [x["doc_id"] for x in d.clean(docs, items).collect()] == [2]
