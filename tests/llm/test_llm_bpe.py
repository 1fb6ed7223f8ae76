"""BPE against the library, for whole texts, cut texts and pieces joined from halves."""

import hashlib
import random
import struct

import pytest

from lexspark.llm import bpe
from lexspark.llm.queries import VOCABULARY

LETTERS = ["aaaaa", "th", "er", "in", "é", "ß", "日本", "🙂", "x", "the", "ing", "0", "9", "_", "--", "́", "ð", "Ⅷ", "‍"]
SPACES = [" ", "\n", "  ", "\t", "\r\n", "<|endoftext|>", "'s", " ", "\x1c", "\x85", "　", " "]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(*VOCABULARY)


def library(codec, text):
    return codec.library.encode(text, add_special_tokens=False).ids


def test_pieces_from_halves(codec):
    r = random.Random(1)
    for _ in range(800):
        text = "".join(r.choice(LETTERS) for _ in range(r.randint(1, 150)))
        leaf, window, ids = r.choice([1, 2, 3, 7, 16]), r.choice([1, 2, 8]), []
        for letters, special in codec.pieces(text):
            ids += [special] if special is not None else codec.tree([codec.merge(h) for h in bpe.halves(letters, leaf)], window)
        assert ids == library(codec, text)


def test_parts_of_texts(codec):
    r = random.Random(2)
    for _ in range(800):
        text = "".join(r.choice(LETTERS + SPACES * 2) for _ in range(r.randint(0, 150)))
        parts = list(bpe.breaks(text, r.choice([1, 3, 10])))
        assert "".join(parts) == text
        ids = [i for p in parts for i in codec.encode(p)]
        assert ids == library(codec, text) == list(codec.encode(text))
        assert codec.decode(ids) == codec.library.decode(ids, skip_special_tokens=False)


def test_decode_of_cut_characters(codec):
    ids = library(codec, "日本🙂é")
    for k in range(len(ids)):
        assert codec.decode(ids[k:]) == codec.library.decode(ids[k:], skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [bpe.LEAF, 40])
def test_encode(spark, codec, leaf):
    r = random.Random(3)
    texts = [None, "", "a", "ab" * 2000, "word " * 500, "é" * 777, "x<|endoftext|>" * 100, " " * 1000, "日本" * 300 + " " + "th" * 900] + [
        "".join(r.choice(LETTERS + SPACES) for _ in range(r.randint(0, 900))) for _ in range(40)]
    rows = [(k, t, "q") for k, t in enumerate(texts)] + [(None, "same " * 50, "q")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    made = bpe.encode(docs, VOCABULARY, leaf=leaf)
    got = made.collect()
    assert len(got) == len(rows) and sum(x["doc_id"] is None for x in got) == 2
    for x in got:
        text = "same " * 50 if x["doc_id"] is None else texts[x["doc_id"]] or ""
        ids = library(codec, text)
        assert x["ids"] == ids and x["n_tokens"] == len(ids)
        assert x["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = {x["doc_id"]: x["text"] for x in bpe.decode(made, VOCABULARY).collect()}
    assert all(back[k] == (t or "") for k, t in enumerate(texts))
    assert bpe.encode(docs.limit(0), VOCABULARY).count() == 0
