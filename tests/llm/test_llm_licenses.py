"""License scans against a search of every place of every text."""

import random
import re

from lexspark.llm import licenses
from lexspark.llm.licenses import REACH, SHARE, TEMPLATES

SCHEMA = "doc_id long, text string, row int, template int, hits string, k int"
MIT = next(t for t in TEMPLATES if t.label == "mit-notice")


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    """(label, base, start, covered, length) of each span, and the score."""
    words, spans, score = split(text), [], 0.0
    for t in TEMPLATES:
        own, k = t.words, t.k
        votes = {}
        for p in range(len(words) - k + 1):
            for q in range(len(own) - k + 1):
                if words[p:p + k] == own[q:q + k]:
                    votes.setdefault(p - q, set()).add(q)
        for d, at in votes.items():
            if t.phrase:
                covered, whole = len(own), len(at) == len(own) - k + 1
                share = float(whole)
            else:
                near = {q for e, qs in votes.items() if abs(e - d) <= REACH for q in qs}
                covered = len({q + i for q in near for i in range(k)})
                whole, share = covered >= SHARE * len(own), covered / len(own)
            score = max(score, share)
            if whole:
                spans.append((t.label, t.base, d, covered, len(own)))
    return sorted(spans), score


def scanned(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, 2, "h", 3) for i, t in rows], SCHEMA)
    return [(r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["score"]) for r in licenses.scan(docs).collect()]


def check(spark, rows):
    got = sorted(scanned(spark, rows), key=repr)
    want = sorted(((i, len(split(t)), *brute(t)) for i, t in rows), key=repr)
    assert got == want


def test_equals_brute_force(spark):
    r = random.Random(5)
    pieces = [t.text for t in TEMPLATES] + ["the", "GNU General", "general public license", "É cc.By", "mit-License", "cc", "by", "nc", "x1", "\n", "license", "apache"]
    texts = [None, "", " \n", "cc by", "CC-BY cc by cc by", "gnu general public\nlicense", "ccby"]
    for _ in range(60):
        words = " ".join(r.choice(pieces) for _ in range(r.randint(1, 6))).split()
        for _ in range(r.randint(0, 12)):
            at = r.randrange(len(words) + 1)
            words[at:at + r.randint(0, 2)] = r.choice([[], ["put"], ["in", "here"]])
        texts.append(" ".join(words))
    check(spark, list(enumerate(texts)))


def test_same_rows_and_ids(spark):
    check(spark, [(1, "mit license"), (1, "mit license"), (1, "x"), (None, "mit license"), (None, None), (None, None), (2, "")])


def test_edited_notice_is_found(spark):
    words = MIT.text.split()
    put_in = [*words[:20], "put", "in", *words[20:50], *words[53:]]
    too_far = words[::2]
    got = {i: ({s[0] for s in spans}, score) for i, _, spans, score in scanned(spark, [(1, " ".join(put_in)), (2, " ".join(too_far)), (3, "x " * 500 + MIT.text.upper())])}
    assert "mit-notice" in got[1][0] and got[1][1] > 0.9
    assert got[2] == (set(), 0.0)
    assert got[3] == ({"mit-notice"}, 1.0)


def test_long_repetitive_text(spark):
    (row,) = scanned(spark, [(1, "cc by " * 50_000)])
    assert len(row[2]) == 50_000 and row[2][0][2] == 0 and row[2][-1][2] == 99_998


def test_no_rows(spark):
    assert scanned(spark, []) == []
