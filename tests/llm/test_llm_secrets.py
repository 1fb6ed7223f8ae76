"""Secret spans against Python's regular expressions and a brute-force entropy."""

import math
import random
import re
from collections import Counter

from lexspark.llm import secrets

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return sorted(spans + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24])


def entropy(value, size):
    most = 0.0
    for i in range(len(value) - size + 1):
        n = Counter(value[i:i + size])
        most = max(most, -sum(c / size * math.log2(c / size) for c in n.values()))
    return most


def added(text):
    text, spans = text or "", base(text)
    out = []
    for k, of in enumerate(secrets.CLASSES):
        new = []
        for m in re.finditer(of.pattern, text):
            v = m.group()
            if any(s[0] <= m.start() and s[2] >= m.end() for s in spans) or not re.search("[0-9]", v) or not re.search("[A-Za-z]", v) or any(re.search(a, v) for a in secrets.ALLOWED):
                continue
            if entropy(v.lower() if of.lower else v, of.window) >= of.bits - 1e-12:
                new.append((m.start(), 3 + k, m.end(), of.kind))
        spans, out = spans + new, out + new
    return sorted(out)


def test_scan(spark):
    r = random.Random(6)
    chars = lambda a, n: "".join(r.choice(a) for _ in range(n))
    parts = [
        lambda: "password", lambda: "PassWd", lambda: "api_key", lambda: "APIKEY", lambda: "token", lambda: "=", lambda: ": ", lambda: "'", lambda: '"', lambda: " ", lambda: "🙂é",
        lambda: "AKIA" + chars("ABC019", r.randint(10, 24)), lambda: chars("0123456789abcdef", r.randint(18, 40)), lambda: chars("0123456789abcdefABCDEF", r.randint(18, 40)),
        lambda: chars(secrets.BASE64, r.randint(10, 60)), lambda: chars("ab1", 30), lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "EXAMPLE" + chars(secrets.BASE64, 30), lambda: "\n"]
    texts = [None, "", "secret: token: abcdef123", "password=token=abcdefgh", "x" * 50_000] + ["".join(r.choice(parts)() for _ in range(r.randint(1, 12))) for _ in range(250)]
    table = spark.createDataFrame([(k, t, "b", "a") for k, t in enumerate(texts)], "doc_id long, text string, base string, added string")
    for row in secrets.scan(table).collect():
        text = texts[row["doc_id"]]
        assert [tuple(s) for s in row["base"]] == base(text), text
        assert [tuple(s) for s in row["added"]] == added(text), text
    assert sum(bool(added(t)) for t in texts) > 20
    assert secrets.scan(table.limit(0)).count() == 0


def test_redact(spark):
    docs = spark.createDataFrame([(1, "é password=hunter22 end"), (2, None), (3, "nothing")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in secrets.redact(docs, secrets.scan(docs)).collect()} == {1: "é [secret] end", 2: "", 3: "nothing"}
