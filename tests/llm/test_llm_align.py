"""Token alignment against offsets worked out token by token, without windows or memory."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from lexspark.llm import align
from lexspark.llm.bpe import _byte_letters
from lexspark.llm.queries import TOKENIZERS

SCHEMA = "doc_id long, text string, pairs int, n_a string, pair int"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spelled(both, text):
    """(id, bytes) of the tokens of either."""
    a, b = both
    byte = {c: i for i, c in enumerate(_byte_letters())}
    first = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        second.append((i, bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return first, second


def ends(tokens):
    at, out = 0, []
    for _, x in tokens:
        at += len(x)
        out.append(at)
    return out


def brute(both, texts):
    rows, counts = [], Counter()
    for text in texts:
        first, second = spelled(both, text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in first) != whole or b"".join(x for _, x in second) != whole:
            rows.append((0, 0, [], []))
            continue
        ends_a, ends_b = ends(first), ends(second)
        links = [(i, j) for (i, _), e in zip(first, ends_a) for (j, _), f in zip(second, ends_b) if e == f]
        groups, start = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            left = [str(i) for (i, _), e in zip(first, ends_a) if start < e <= cut]
            right = [str(j) for (j, _), e in zip(second, ends_b) if start < e <= cut]
            groups.append(f"{','.join(left)}|{','.join(right)}")
            start = cut
        counts.update(links)
        rows.append((len(first), len(second), groups, links))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(
        n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
        hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for n_a, n_b, groups, links in rows]


def aligned(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)
    got = align.align(docs, TOKENIZERS).collect()
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got), key=repr)


def check(spark, both, rows):
    want = [(i, *row) for (i, _), row in zip(rows, brute(both, [t for _, t in rows]))]
    assert aligned(spark, rows) == sorted(want, key=repr)


def random_texts(seed, n):
    r = random.Random(seed)
    bits = ["the", " ", "  ", "\n", "tokenizer", "Donaudampfschiff", "é", "日本", "▁", "<s>", "<|endoftext|>", "<0x41>", "😀", "\t", "123456", "á", " ", "...", "'ll", "\r\n", "\x00"]
    return ["".join(r.choice(bits) + r.choice([" ", "", " "]) for _ in range(r.randint(1, 40))) for _ in range(n)]


def test_equals_brute_force(spark, both):
    texts = [None, "", " ", "a", "\n\n", "   lead", "trail  ", "The cat sat on the mat. The cat sat.", "x" * 300, "the " * 400, "▁a", "ééé" * 50, *random_texts(1, 60)]
    check(spark, both, list(enumerate(texts)))


def test_same_rows_and_ids(spark, both):
    check(spark, both, [(1, "same text"), (1, "same text"), (1, "other text"), (None, "same text"), (None, None), (None, None)])


def test_windows_are_remembered_within_a_bound(monkeypatch, both):
    own = align.Vocabularies(TOKENIZERS)
    texts = random_texts(2, 40)
    once = [[x.tolist() if hasattr(x, "tolist") else x for x in row] for row in own.align(texts)]
    known = dict(own.memory)
    assert known and [[x.tolist() if hasattr(x, "tolist") else x for x in row] for row in own.align(texts)] == once and own.memory == known
    monkeypatch.setattr(align, "MEMORY", 0)
    assert [[x.tolist() if hasattr(x, "tolist") else x for row_ in [row] for x in row_] for row in own.align(texts)] == once
    own.align(["one word"])
    assert len(own.memory) <= 2


def test_windows_begin_with_a_space(both):
    own = align.Vocabularies(TOKENIZERS)
    _, _, keys = own.cut("Some quite plain words of a text")
    assert len(keys) == 7


def test_every_link_is_a_known_pair(both):
    own = align.Vocabularies(TOKENIZERS)
    pairs = set(map(tuple, own.pairs.tolist()))
    assert len(pairs) < 1_000_000
    for text in random_texts(3, 30):
        first, second = spelled(both, text)
        if b"".join(x for _, x in first) == b"".join(x for _, x in second):
            assert {(i, j) for (i, _), e in zip(first, ends(first)) for (j, _), f in zip(second, ends(second)) if e == f} <= pairs


def test_long_text_without_a_break(spark, both):
    text = "abcdefghij" * 20_000
    (row,) = aligned(spark, [(7, text)])
    first, second = spelled(both, text)
    assert row[1:3] == (len(first), len(second)) and row[3] == len(set(ends(first)) & set(ends(second)))


def test_no_rows(spark):
    assert aligned(spark, []) == []
