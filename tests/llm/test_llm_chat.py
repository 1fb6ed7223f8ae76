"""Chat windows: read back exactly, targets once, budgets kept, blocks of long conversations."""

import hashlib
import random

import pytest

from lexspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = ["a", "<turn:", "</turn>", "\\", "</turn>\n", ">\n", "### Assistant:", "é🙂", "\n", " ", "<\\turn:", "longer words here"]


def conversations(seed, count=30, turns=40):
    r = random.Random(seed)
    rows = []
    for c in range(count):
        for t in range(r.randint(1, turns)):
            role = "system" if t == 0 and c % 2 else r.choice(["user", "assistant"]) if c % 5 else r.choice(["user", "system", "assistant", "x>\ny", "\\"])
            rows.append((c, t, role, "".join(r.choice(WORDS) for _ in range(r.randint(0, 30)))))
    return rows


def said(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


@pytest.mark.parametrize("budget,history,block", [(40, 10, 1024), (60, 30, 8), (1, 0, 16), (10_000, 100, 1024)])
def test_read_back(spark, budget, history, block):
    rows = conversations(budget)
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=budget, history_tokens=history, history_turns=3, block=block)
    want = said(rows)
    for r in chat.conversations_read_back(windows).collect():
        turns = want.pop(r["conv_id"])
        targets = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(targets), hashlib.sha256(targets.encode()).hexdigest())
    assert not want


@pytest.mark.parametrize("block", [8, 1024])
def test_windows(spark, block):
    rows = conversations(5)
    budget, history = 60, 20
    size = lambda t: -(-len(t) // 4)
    want = said(rows)
    by = {}
    for w in chat.read_windows(chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=budget, history_tokens=history, history_turns=3, block=block)).collect():
        by.setdefault(w["conv_id"], []).append(w)
    template = chat.Template()
    for c, windows in by.items():
        windows.sort(key=lambda w: (w["block"], w["window"]))
        seen, system = 0, next((k for k, (role, _) in enumerate(want[c]) if role == "system"), None)
        for w in windows:
            assert w["formatted"].count(template.closing) == w["n_turns"] and w["n_turns"] - w["n_repeated"] == len(w["turns"])
            assert [(t["role"], t["text"]) for t in w["turns"]] == want[c][seen:seen + len(w["turns"])]
            assert w["n_tokens"] <= budget or len(w["turns"]) == 1
            shows_system = w["formatted"].startswith("<turn:system>\n")
            assert shows_system or system is None or seen <= system
            assert w["n_repeated"] - (shows_system and seen > (system or 0)) <= 3
            seen += len(w["turns"])
        assert seen == len(want[c])


def test_odd_rows(spark):
    odd = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "late"), (None, 0, "assistant", ""), (2, 3, "assistant", "x" * 100_000)]
    table = spark.createDataFrame([(*r, "own", 1) for r in odd], SCHEMA + ", formatted string, window int")
    got = {r["conv_id"]: r for r in chat.conversations_read_back(chat.format_windows(table)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(b"user\n\nuser\n\n\nlate\n").hexdigest()
    assert got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 100_000
    assert chat.format_windows(table.limit(0)).count() == 0
