import random
import re

import pytest
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions import rules
from lexspark.functions.spans import UnboundedPattern, words_spanned
from lexspark.operators import verdicts
from lexspark.plans import datasets


def run(spark, step, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in rows.select("i", step(F.col("x")).alias("y")).orderBy("i").collect()]


def test_outcomes(spark):
    cases = {
        "": "altro", "testo": "altro",
        "è dichiarata l'illegittimità costituzionale": "illegittimo",
        "è dichiarata l’illegittimità costituzionale": "altro",
        "DICHIARA L'ILLEGITTIMITÀ  COSTITUZIONALE": "illegittimo",
        "dichiarato illegittimità costituzionale": "altro",
        "dichiarato costituzionalmente lillegittimita costituzionale": "illegittimo",
        "costituzionalmente\xa0illegittimo": "illegittimo",
        "la questione non\nfondata": "non_fondata", "nonfondata": "altro",
        "inammissibile": "inammissibile", "manifestamente infondata": "manifestamente_infondata",
        "manifestamente inammissibile": "misto", "non fondata e costituzionalmente illegittima": "misto",
    }
    assert run(spark, rules.outcome, *cases) == list(cases.values())
    assert run(spark, rules.outcome, None) == ["altro"]


def test_title_numbers(spark):
    cases = {
        "Modifiche agli articoli 56, 57 e 60 della Costituzione": [56, 57, 60],
        "Modificazioni degli articoli 131 e 57, 131 della Costituzione": [131, 57, 131],
        "MODIFICA agli articolo 3": [3],
        "Modifica all'articolo 119 della Costituzione": [119],
        "Modifica dell’articolo 9  della Costituzione": [9],
        "Revisione dell'articolo 79 della Carta": [79],
        "Modifiche al titolo V della parte seconda": list(range(114, 134)),
        "Modifiche al titolo v della parte seconda": [],
        "Modifiche al titolo X della parte seconda": [],
        "Modifica dell'articolo 88, secondo comma, della Costituzione": [],
        "Revisione dell'articolo 5 e modifiche agli articoli 7 e 8": [7, 8],
        "": [],
    }
    assert run(spark, rules.title_numbers, *cases) == list(cases.values())


def test_body_numbers(spark):
    def link(n, label="art. 1 della Costituzione"):
        return f"[{label}](/x#art_{n}~a)"

    body = (
        f"---\ntitolo: x\n---\n{link(900)} modificato\n## Art. 1.\n{link(30)} è Sostituito {link(4)} {link(30)}\n"
        f"## Art. 2.\n{link(901)}\n##  Art. 3\naggiunto {link(5, 'COSTITUZIONE')} {link(902, 'legge')}\nNote all'art.\n{link(903)}\n"
        f"## Art. 4\nNote \nabrogato {link(904)}"
    )
    assert run(spark, rules.body_numbers, body, f"modificato {link(1)}", "") == [[4, 5, 30], [], []]
    assert run(spark, rules.body_numbers, f"## Art. 1\nNote: inserito {link(7)}") == [[7]]


def test_revisions(spark):
    laws = {
        "a.md": '---\nurn: u\ntitolo: "Modifica all\'articolo 3 della Costituzione"\n---\n',
        "b.md": "---\ntitolo: Statuto speciale, modifica all'articolo 3 della Costituzione\n---\n",
        "c.md": "---\ntitolo: Indizione di un referendum all'articolo 3 della Costituzione\n---\n",
        "d.md": "---\ndata: 2001\n---\n## Art. 1\nsoppresso [Costituzione](#art_8) [Costituzione](#art_2)",
        "Revisione dell'articolo 7.md": "niente",
    }
    rows = datasets.revisioni(spark.createDataFrame(list(laws.items()), "file_name string, value string")).collect()
    assert [tuple(r) for r in rows] == [
        ("u", "", "", "Modifica all'articolo 3 della Costituzione", [3], 1, "modifica_costituzione"),
        ("", "", "", "Statuto speciale, modifica all'articolo 3 della Costituzione", [], 0, "statuto_speciale"),
        ("", "", "", "Indizione di un referendum all'articolo 3 della Costituzione", [], 0, "altra_legge_costituzionale"),
        ("", "", "2001", "d", [2, 8], 2, "modifica_costituzione"),
        ("", "", "", "Revisione dell'articolo 7", [7], 1, "modifica_costituzione"),
    ]


WORDS = [
    "non", "fondata", "fondate", "inammissibile", "manifestamente", "dichiara", "costituzionalmente", "illegittimo",
    "l'illegittimità", "costituzionale", "la", "legge", "", " ", "\n", "fondata\n", " non",
]


def joined_outcome(texts):
    whole = " ".join(t for t in texts if t)
    hits = [
        name for name, pattern in fixed.OUTCOME_PATTERNS.items()
        if re.search(re.sub(r"^\(\?iU\)", "", pattern), whole, re.IGNORECASE)
    ]
    return "altro" if not hits else hits[0] if len(hits) == 1 else "misto"


@pytest.mark.parametrize(("chunk_bits", "position_bits"), [(4, 12), (2, 11), (14, 42), (14, 11)])
def test_group_outcome_equals_joining(spark, chunk_bits, position_bits):
    """Small chunks make matches cross chunk borders; group 0 holds a third of all rows."""
    rng = random.Random(chunk_bits)
    rows, groups = [], {}
    for key in range(120):
        size = 600 if key == 0 else rng.randint(1, 20)
        vocabulary = rng.sample(WORDS, 7)
        groups[key] = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 1, 2, 9]))) for _ in range(size)]
        gap = rng.choice([1, 3])
        rows += [(key, 5 + gap * i, t) for i, t in enumerate(groups[key])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, at bigint, t string")
    got = dict(map(tuple, verdicts.group_outcome(df, "k", "at", "t", position_bits=position_bits, chunk_bits=chunk_bits).collect()))
    assert got == {key: joined_outcome(texts) for key, texts in groups.items()}
    assert len(set(got.values())) > 3


def test_group_outcome_single_words(spark):
    df = spark.createDataFrame([(1, 0, "aaa"), (1, 1, "bbb"), (2, 0, ""), (3, 0, None)], "k bigint, at bigint, t string")
    got = verdicts.group_outcome(df, "k", "at", "t", {"a": "a", "b": "b"}, words=1)
    assert {tuple(r) for r in got.collect()} == {(1, "misto"), (2, "altro"), (3, "altro")}


def test_words_spanned():
    for pattern, words in {r"a": 1, r"a\s+b": 2, r"(?iU)a(?:\s+b)?\s+c|d": 3, r"uno\s+due\s+tre\s+quattro\s+cinque\s+sei": 6, r"\ba\b\s": 2, r"(?:a\s){3}": 4, r"[a-z]+\s*[a-z]*": 2}.items():
        assert words_spanned(pattern) == words
    for pattern in (r"c\W+g", r"a.b", r"a[^b]c", r"(?:a\s+)+", r"^a", r"a$", r"a(?=b)", r"(a)\1", r"[\s,]+", r"a\x00"):
        with pytest.raises(UnboundedPattern):
            words_spanned(pattern)


def test_group_outcome_over_many_words(spark):
    df = spark.createDataFrame([(1, 0, "x x x x uno due tre quattro"), (1, 1, "cinque sei y y y y"), (2, 0, "a b c d e f g h i")], "k bigint, at bigint, t string")
    assert dict(map(tuple, verdicts.group_outcome(df, "k", "at", "t", {"sei": r"uno\s+due\s+tre\s+quattro\s+cinque\s+sei"}).collect())) == {1: "sei", 2: "altro"}
    for bad in ({"p": r"c\W+g"}, {"p": r"a.*b"}):
        with pytest.raises(UnboundedPattern):
            verdicts.group_outcome(df, "k", "at", "t", bad)
    with pytest.raises(ValueError):
        verdicts.group_outcome(df, "k", "at", "t", {"p": r"a\s+b\s+c"}, words=2)


@pytest.mark.parametrize("places", [(3, 3), (-1, 0), (0, 1 << 43), (0, None)])
def test_group_outcome_checks_positions(spark, places):
    df = spark.createDataFrame([(1, p, "a") for p in places], "k bigint, at bigint, t string")
    with pytest.raises(Exception, match="a position"):
        verdicts.group_outcome(df, "k", "at", "t", {"p": r"a\s+b"}).collect()


def test_each_outcome_pattern_runs_once(spark):
    df = spark.createDataFrame([("x",)], "t string").select(rules.outcome(F.col("t")).alias("esito"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.upper().count("RLIKE") == len(fixed.OUTCOME_PATTERNS)
