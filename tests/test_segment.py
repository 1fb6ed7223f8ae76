import random
import re

from pyspark.sql import functions as F

from lexspark.operators import segment
from lexspark.sources import documents

FIELDS = ["numero", "articolo", "disposizione", "parte", "titolo", "sezione", "heading", "testo", "commi"]
FINAL = "Disposizioni transitorie e finali"


def segments(spark, *docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc int, value string")
    out = segment.segment_documents(df, "value", ("doc",)).orderBy("doc", "ordine")
    return [(r.doc, *[r[f] for f in FIELDS]) for r in out.collect()]


def test_hierarchy(spark):
    doc = "# P\n## T\n### S\n## Art. 1\na\n\nb\n## Art. 2\n### I\nc\n# Disposizioni x\n### II\nd"
    assert segments(spark, doc) == [
        (0, "1", 1, None, "P", "T", "S", "Art. 1", "a\n\nb", 2),
        (0, "2", 2, None, "P", "T", "S", "Art. 2", "", 0),
        (0, None, None, "I", "P", "T", "S", "Disposizione transitoria I", "c", 1),
        (0, None, None, "II", FINAL, "", "", "Disposizione transitoria II", "d", 1),
    ]


def test_heading_quirks(spark):
    doc = (
        "prima\n## Art. 7-bis\npersa\n## Art. 7b\nuno\n## Art. 8 \n## Art.9\ndata: persa\n# Art. 1\n"
        "#  Disposizioni\n### iv\nfuori\n## Art. 10\n\xa0\n  x"
    )
    assert segments(spark, doc) == [
        (0, "7b", None, None, "", "", "", "Art. 7b", "uno\n## Art. 8", 1),
        (0, "9", 9, None, "", "", "", "Art. 9", "# Art. 1\n#  Disposizioni", 1),
        (0, "10", 10, None, "", "", "iv", "Art. 10", "x", 1),
    ]


def test_no_headings(spark):
    assert segments(spark, "", "solo testo", "# Parte\ntesto") == []


POOL = [
    "# Uno", "#  Due ", "# Disposizioni finali", "# Art. x", "## Titolo", "##\tTab", "## Disposizioni", "## Art. 3",
    "## Art. 3b", "## Art.4", "## Art. 5 ", "## Art. 6-bis", "### Sezione", "### I", "### XIV", "### I ", "###  V", "### Art. 2",
    "#### quattro", "#solo", "", "", " ", "testo", "  rientro", "tipo: x", "---", "--- y", "datato", "data:z", "\xa0", " # A",
]


def kind(line):
    """Heading kind and label of one line."""
    art, label = "Art." in line, re.sub(r"^#+\s+", "", line)
    if line.startswith("# Disposizioni"):
        return "P", FINAL
    if re.match(r"#\s+.", line) and not art and "Disposizioni" not in line:
        return "P", label
    if re.match(r"##\s+.", line) and not art:
        return "T", label
    if re.match(r"###\s+.", line) and not art:
        return ("X", label) if re.fullmatch("[IVXLCDM]+", label) else ("S", label)
    found = re.fullmatch(r"## Art\.\s*(\d+[bis]?)", line)
    return ("A", found[1]) if found else (None, None)


def by_looking_back(doc):
    """For every article or provision, search its context backwards and its text forwards."""
    lines = [line for line in doc.split("\n") if not re.match("---|tipo:|data:", line)]
    kinds = [kind(line) for line in lines]

    def above(i, wanted, stop):
        for k, label in reversed(kinds[:i]):
            if k == wanted:
                return label
            if k in stop:
                return ""
        return ""

    for i, (k, label) in enumerate(kinds):
        if k in ("A", "X"):
            end = next((j for j in range(i + 1, len(lines)) if kinds[j][0]), len(lines))
            body = "\n".join(lines[i + 1:end]).strip()
            number = label if k == "A" else None
            yield (
                number, int(number) if number and number.isdigit() else None, label if k == "X" else None,
                above(i, "P", ()), above(i, "T", ("P",)), above(i, "S", ("P", "T")),
                f"Art. {label}" if k == "A" else f"Disposizione transitoria {label}",
                body, len(body.split("\n\n")) if body else 0,
            )


def test_random_documents(spark):
    rng = random.Random(7)
    docs = ["\n".join(rng.choice(POOL) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    assert segments(spark, *docs) == [(i, *row) for i, doc in enumerate(docs) for row in by_looking_back(doc)]


def test_one_narrow_stage(spark):
    df = spark.createDataFrame([("x",)], "value string")
    plan = segment.segment_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_frontmatter(spark):
    docs = [
        '---\ntitolo: "Uno: \'due\'"\nurn: a\nurn: b\n senza\n: vuota\n---\ncorpo: no',
        "--- \n\ndata:\n---", "titolo: x", "---\nsenza fine",
        '---\ntitolo: \'"x"\'\n---', '---\ntitolo: ""\n---',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, value string").withColumn(
        "e", segment.frontmatter_entries(F.col("value"))
    )
    maps = [r.m for r in df.select("i", segment.frontmatter_map(F.col("e")).alias("m")).orderBy("i").collect()]
    assert maps == [
        {"titolo": "Uno: 'due", "urn": "b", "": "vuota"}, {"data": ""}, {}, {}, {"titolo": '"x"'}, {"titolo": ""},
    ]
    titles = df.select("i", segment.with_default_title(F.col("e"), F.lit("legge.md")).alias("t")).orderBy("i").collect()
    assert [r.t for r in titles] == ["Uno: 'due", "legge", "legge", "legge", '"x"', ""]
    assert segment.document_fields(df.select("i", "value"), "value", ("urn", "tipo")).where("i = 0").first()[2:] == ("b", "")


def by_document(df, name):
    rows = df.orderBy(name, "ordine").collect()
    return [tuple(r[c] for c in (name, *FIELDS)) for r in rows]


def test_lines_in_splits(spark):
    """Documents cut anywhere give the rows of whole documents, whatever lies in a split."""
    r = random.Random(7)
    docs = [(k, "\n".join(r.choice(POOL) for _ in range(r.randint(0, 60)))) for k in range(40)]
    whole = segment.segment_documents(spark.createDataFrame(docs, "doc int, value string"), "value", ("doc",))
    want = by_document(whole, "doc")
    assert len(want) > 100
    for size in (1, 3, 1000):
        cut = [(k, i // size - 5, i % size * 7, line) for k, text in docs for i, line in enumerate(text.split("\n"))]
        r.shuffle(cut)
        lines = spark.createDataFrame(cut, "doc int, split long, at int, line string")
        assert by_document(segment.segment_lines(lines, "doc"), "doc") == want


def test_files_larger_than_a_split(spark, tmp_path):
    r = random.Random(8)
    for k in range(3):
        (tmp_path / f"d {k}.md").write_text("\r\n".join(r.choice(POOL) for _ in range(3000 * k + 5)) + "\n", newline="")
    whole = segment.segment_documents(documents.read_documents(spark, str(tmp_path)), "value", ("file_name",))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        lines = documents.read_lines(spark, str(tmp_path))
        assert lines.select("split").distinct().count() > 5
        assert by_document(segment.segment_lines(lines), "file_name") == by_document(whole, "file_name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_lines(spark):
    assert segment.segment_lines(spark.createDataFrame([], "file_name string, split long, at long, line string")).count() == 0
