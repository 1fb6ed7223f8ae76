"""Enrichment, metrics, contract checks, readers and writers."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark import schemas
from lexspark.operators import enrich, metrics, quality
from lexspark.plans import datasets, questions
from lexspark.sources import documents, tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- enrichment --------------------------------------------------------------------------------
def test_citation_text(spark):
    articles = spark.createDataFrame(
        [(2, "nuovo", 2), (1, "x" * 301, 0), (2, "vecchio", 1), (3, "", 3), (None, "nullo", 4), (2, "", 5)], "articolo bigint, testo string, ordine int"
    )
    cites = spark.createDataFrame(
        [(f"f{i}", "c", 2000, "t", a, "ctx") for i, a in enumerate([1, 2, 3, 4, None, 2])],
        "fonte_filename string, fonte_collezione string, fonte_anno bigint, fonte_tipo string, articolo bigint, contesto string",
    )
    got = datasets.citazioni_legislative(cites, articles, F.col("ordine")).orderBy("fonte_filename")
    assert got.columns == schemas.CITAZIONI.names
    assert [r.articolo_testo for r in got.collect()] == ["x" * 300, "nuovo", "", "", "", "nuovo"]
    assert datasets.citazioni_legislative(cites, None, F.col("ordine")).columns == schemas.CITAZIONI.names[:-1]


@pytest.mark.parametrize("longer", [0, 1])
def test_published_citations_go_by_file_and_row(spark, tmp_path, longer):
    """The last text of an article is that of the last file, whatever the files' sizes."""
    for k, text in enumerate(("primo", "secondo")):
        extra = [(100 + i, "y" * 2000) for i in range(3000 if k == longer else 1)]
        spark.createDataFrame([(1, text), *extra], "articolo bigint, testo string").coalesce(1).write.parquet(str(tmp_path / "x" / str(k)))
        part = next((tmp_path / "x" / str(k)).glob("part-*.parquet"))
        (tmp_path / "articles").mkdir(exist_ok=True)
        part.rename(tmp_path / "articles" / f"part-{k}.parquet")
    spark.createDataFrame([("f", "c", 2000, "t", 1, "")], "fonte_filename string, fonte_collezione string, fonte_anno bigint, fonte_tipo string, articolo bigint, contesto string").write.parquet(str(tmp_path / "cites"))
    datasets.publish_citazioni(spark, str(tmp_path / "cites"), str(tmp_path / "articles"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "parquet")).first().articolo_testo == "secondo"


def registry_file(folder, *entries):
    path = folder / "registry.json"
    path.write_text(json.dumps({"version": 1, "datasets": list(entries)}, indent=1))
    return str(path)


def test_indicators(spark, tmp_path):
    registry = tables.read_registry(spark, registry_file(
        tmp_path, {"slug": "a", "name": "Vecchio", "source": "s"}, {"slug": "a", "name": "A"}, {"slug": "b", "name": None, "source": "t"},
        {"slug": "", "name": "x"}, {"name": "y"}, {"slug": "c"},
    ))
    lines = [
        {"ordinal": 0, "articolo": 9, "dataset_slug": "b", "dimensione": "d", "tipo": "strutturale"},
        {"ordinal": 1, "articolo": 3, "dataset_slug": "a"}, {"ordinal": 2, "articolo": 0, "dataset_slug": "a"},
        {"ordinal": 3, "dataset_slug": "a"}, {"ordinal": 4, "articolo": 9, "dataset_slug": ""}, {"ordinal": 5, "articolo": 3, "dataset_slug": "c"},
    ]
    (tmp_path / "mapping.json").write_text("\n".join(map(json.dumps, lines)))
    mapping = tables.read_mapping(spark, str(tmp_path / "mapping.json"))
    table = datasets.indicatori_costituzionali(mapping, registry).orderBy("articolo", "ordinal")
    assert [tuple(r)[1:] for r in table.collect()] == [
        (3, "a", "A", "", "", "outcome"), (3, "c", "c", "", "", "outcome"), (9, "b", None, "t", "d", "strutturale"),
    ]
    bad = mapping.unionByName(spark.createDataFrame([(9, 1, "zz", "", "", 1), (8, 1, "yy", "", "", 1)], mapping.schema))
    with pytest.raises(enrich.MissingReferences, match="2 missing: yy, zz"):
        enrich.require_references(bad, registry)
    out = str(tmp_path / "out")
    datasets.publish_indicatori(spark, str(tmp_path / "mapping.json"), str(tmp_path / "registry.json"), out)
    assert tables.read_csv(spark, f"{out}/csv", schemas.INDICATORI).count() == 3


def test_hot_key(spark):
    """A third of the rows has one key, another part none: nothing is lost or doubled."""
    rng = random.Random(3)
    keys = [7] * 2000 + [None] * 500 + [rng.randint(0, 300) for _ in range(3500)]
    left = spark.createDataFrame(list(enumerate(keys)), "i bigint, articolo bigint")
    right = spark.createDataFrame([(k, k * 10 + v, f"{k}-{v}") for k in range(200) for v in range(k % 3)],
                                  "articolo bigint, at bigint, testo string")
    want = [(i, k, f"{k}-{k % 3 - 1}" if k is not None and k < 200 and k % 3 else "") for i, k in enumerate(keys)]
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = enrich.add_snippet(left, right, "articolo", "testo", F.col("at"))
            assert sorted(map(tuple, got.collect())) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    missing = enrich.missing_keys(left, right, "articolo")
    assert {r[0] for r in missing.collect()} == {k for k in keys if k is not None} - {k for k in range(200) if k % 3}


def test_skew_split_is_possible(spark):
    """Without broadcast, both sides of a lookup join are plain exchanges, so AQE may split a hot key."""
    left = spark.range(1000).select((F.col("id") % 7).alias("articolo"))
    right = spark.range(50).select(F.col("id").alias("articolo"), F.lit("t").alias("testo"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, value in (("skewedPartitionFactor", "1.1"), ("skewedPartitionThresholdInBytes", "100b")):
        spark.conf.set(f"spark.sql.adaptive.skewJoin.{name}", value)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200b")
    try:
        hot = left.withColumn("articolo", F.lit(3).cast("bigint")).unionByName(left).repartition(8)
        joined = enrich.add_snippet(hot, right, "articolo", "testo", F.lit(0))
        assert joined.where("articolo_testo = 't'").count() == 2000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionFactor",
                     "adaptive.skewJoin.skewedPartitionThresholdInBytes", "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{name}")


# --- metrics and questions ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def six(spark):
    one = lambda names, data: spark.createDataFrame(data, names)
    return {
        "articles": one("articolo bigint, testo string", [(i, "t") for i in (1, 2, 3, 9)] + [(None, "t")]),
        "acts": one("parametro_articolo bigint", [(3,), (3,), (0,), (9,), (200,)]),
        "maxims": one("parametro_articolo string, esito string", [
            ("3", "illegittimo"), ("3", "non_fondata"), ("3", "misto"), ("9", "altro"), ("", "illegittimo"), ("117 bis", "altro")]),
        "citations": one("articolo bigint, fonte_filename string, fonte_collezione string, fonte_anno bigint, fonte_tipo string", [
            (1, "a", "c", 1, "t"), (1, "a", "c", 1, "t"), (3, "b", "c", 1, "t"), (None, "c", "c", 1, "t"), (7, "a", "c", 1, "t")]),
        "revisions": one("articoli_modificati array<bigint>", [([3, 9, 3],), ([],), ([9],)]),
        "indicators": one("articolo bigint, dataset_slug string, dataset_name string, dimensione string", [
            (9, "s", "S", "d"), (9, "s", "S", "d"), (3, "u", "U", "e")]),
    }


def test_scorecard(six):
    assert rows(questions.article_scorecard(**six)) == [
        (1, 0, 0, 0, 2, 0, 0, None), (2, 0, 0, 0, 0, 0, 0, None), (3, 2, 3, 1, 1, 2, 1, 100.0 / 3), (9, 1, 1, 0, 0, 2, 2, 0.0),
    ]


def test_questions(six):
    assert rows(questions.most_amended(six["revisions"])) == [(3, 2), (9, 2)]
    assert [tuple(r) for r in questions.most_invoked(six["acts"]).collect()] == [(3, 2), (0, 1), (9, 1), (200, 1)]
    assert rows(questions.outcomes_of(six["maxims"], 3)) == [("illegittimo", 1), ("misto", 1), ("non_fondata", 1)]
    assert ("3", 1, 1, 3) in rows(questions.outcomes(six["maxims"]))
    assert rows(questions.laws_citing(six["citations"], 1)) == [("a", "c", 1, "t")]
    assert rows(questions.datasets_for(six["indicators"], 9)) == [("s", "S", "d")]
    assert [tuple(r) for r in questions.citations_per_article(six["citations"]).collect()] == [(1, 2), (3, 1), (7, 1)]
    assert rows(questions.cited_never_litigated(six["citations"], six["acts"], six["maxims"])) == [(1,), (7,)]
    assert rows(questions.without_implementing_law(six["articles"], six["citations"])) == [(2,), (9,)]
    assert rows(questions.most_accepted(six["maxims"])) == [("", 1), ("3", 1)]


def test_metrics(spark):
    rng = random.Random(5)
    data = [(rng.randint(1, 6), rng.randint(1, 3), rng.randint(1, 9), rng.choice(["altro", "misto", "illegittimo"])) for _ in range(500)]
    df = spark.createDataFrame(data, "anno_pronuncia bigint, numero_pronuncia bigint, id_massima bigint, esito string")
    decided = sum(r[3] != "altro" for r in data)
    assert tuple(metrics.maxim_totals(df).first()) == (
        500, len({r[:2] for r in data}), len({r[2] for r in data}), decided, decided * 100.0 / 500)
    counts = Counter(r[3] for r in data)
    assert rows(metrics.shares(df, "esito")) == sorted((k, n, n * 100.0 / 500) for k, n in counts.items())
    tied = spark.createDataFrame([(k,) for k in (5, 5, 1, 1, 3, 2, 4, 6)], "k bigint")
    assert [tuple(r) for r in metrics.top(tied, "k", 3).collect()] == [(1, 2), (5, 2), (2, 1)]
    empty = df.limit(0)
    assert tuple(metrics.maxim_totals(empty).first()) == (0, 0, 0, 0, None)
    rate = spark.createDataFrame([(1, "illegittimo")] * 30 + [(1, "misto")] * 21 + [(2, "illegittimo")] * 50, "parametro_articolo bigint, esito string")
    assert rows(metrics.acceptance_rate(rate)) == [(1, 30 * 100.0 / 51)]


def test_contract_checks(spark):
    df = spark.createDataFrame(
        [(1, "ordinanza", [9], "a<ref>"), (None, "x", None, ""), (3, None, [], "## Art. 1\n## Art. 2")],
        "articolo bigint, tipo string, numeri array<bigint>, testo string",
    )
    report = quality.dq_report(df, [
        quality.rows_exactly(3), quality.not_null_exactly("articolo", 3), quality.has_value("articolo", 32),
        quality.only_values("tipo", ["ordinanza"]), quality.array_has("numeri", 9), quality.no_match("testo", "<ref>"),
        quality.not_empty("testo"), quality.marker_count("testo", r"(?m)^## Art\.", 2, 2),
        quality.at_least_where("tipi", F.col("tipo") == "x", 1), quality.always("positivo", F.col("articolo") > 0),
    ])
    assert [tuple(r)[1:] for r in report.collect()] == [
        (True, 3), (False, 2), (False, 0), (False, 2), (True, 1), (False, 1), (False, 1), (True, 2), (True, 1), (False, 1),
    ]
    assert rows(quality.schema_report(df, {"articolo": "bigint", "altro": None, "testo": "bigint"})) == [
        ("column altro", False, 0), ("column articolo", True, 1), ("column testo", True, 1),
        ("type articolo bigint", True, 1), ("type testo bigint", False, 0),
    ]
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert rows(quality.reference_report(df, parent, "articolo", "id")) == [("articolo references", False, 1)]


# --- files -------------------------------------------------------------------------------------
AWKWARD = ['a"b', "a,b", "a\nb", 'a\\"b', "\\", "", " spazi ", "é ", "a\r\nb", '"', "\t"]


def test_csv_roundtrip(spark, tmp_path):
    data = [(i, t, t[::-1], [i, 2]) for i, t in enumerate(AWKWARD)] + [(99, None, "x", [])]
    df = spark.createDataFrame(data, "n bigint, a string, b string, l array<bigint>")
    out = str(tmp_path / "t")
    tables.write_csv(df, out)
    back = tables.read_csv(spark, out, schemas.struct(schemas.long("n"), "a", "b", "l"))
    assert sorted(map(tuple, back.collect())) == sorted((n, a or "", b, ", ".join(map(str, x))) for n, a, b, x in data)


def test_csv_written_elsewhere(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'titolo,articoli,n\r\n"Norme ""nuove"", \\""x\\""",,0\r\n"a\nb","131, 57",2\r\n')
    got = tables.read_csv(spark, str(tmp_path / "t.csv"), schemas.struct("titolo", "articoli", schemas.long("n")))
    assert rows(got) == [('Norme "nuove", \\"x\\"', "", 0), ("a\nb", "131, 57", 2)]


def test_documents(spark, tmp_path):
    (tmp_path / "b.md").write_text("due\n\n", encoding="utf-8")
    (tmp_path / "a.md").write_bytes("é\r\nuno".encode())
    (tmp_path / "c.txt").write_text("no")
    (tmp_path / "sotto").mkdir()
    (tmp_path / "sotto" / "d.md").write_text("no")
    docs = documents.read_documents(spark, str(tmp_path))
    assert rows(docs) == [("a.md", "é\nuno"), ("b.md", "due\n\n")]
    assert rows(documents.read_document(spark, str(tmp_path / "c.txt"))) == [("c.txt", "no")]
    assert rows(documents.read_documents(spark, str(tmp_path / "manca"))) == []
    with pytest.raises(FileNotFoundError):
        documents.read_document(spark, str(tmp_path / "manca"))
    out = tmp_path / "out"
    documents.write_documents(docs.selectExpr("file_name AS documento", "value || '\\n' AS contenuto"), str(out))
    assert len(list(out.glob("part-*"))) <= 2
    assert rows(documents.read_written_documents(spark, str(out))) == [("a.md", "é\nuno\n"), ("b.md", "due\n\n\n")]
    flat = tmp_path / "flat"
    documents.write_text(docs.selectExpr("value || '\n' AS contenuto"), str(flat))
    assert sorted(p.read_text("utf-8") for p in flat.glob("part-*")) == ["due\n\n\n", "é\nuno\n"]


def test_publish(spark, tmp_path):
    (tmp_path / "t.md").write_text("# P\n## Art. 1\nuno\n## Art. 2b\n### IV\nq\n", encoding="utf-8")
    out = str(tmp_path / "tables" / "articoli")
    datasets.publish_articoli(spark, str(tmp_path / "t.md"), out)
    assert rows(spark.read.parquet(f"{out}/parquet").select("articolo", "disposizione", "heading", "commi")) == [
        (1, None, "Art. 1", 1), (None, "IV", "Disposizione transitoria IV", 1), (None, None, "Art. 2b", 0),
    ]
    csv = tables.read_csv(spark, f"{out}/csv", schemas.struct("articolo", *schemas.ARTICOLI.names[1:]))
    assert rows(csv.select("articolo", "disposizione", "testo", "commi")) == [("", "IV", "q", "1"), ("1", "", "uno", "1"), ("2b", "", "", "0")]
    assert datasets.register_views(spark, str(tmp_path / "tables")) == ["articoli"]
    assert spark.sql("SELECT count(articolo) FROM articoli WHERE commi > 0").first()[0] == 1
    with pytest.raises(ValueError):
        datasets.publish_revisioni(spark, str(tmp_path / "manca"), str(tmp_path / "rev"))
    (tmp_path / "zip").mkdir()
    assert not (tmp_path / "rev").exists()
    assert not datasets.publish_atti_promovimento(spark, str(tmp_path / "zip"), str(tmp_path / "atti"))
    assert not (tmp_path / "atti").exists()
    datasets.publish_massime(spark, str(tmp_path / "zip"), str(tmp_path / "massime"))
    assert spark.read.parquet(str(tmp_path / "massime" / "parquet")).columns == schemas.MASSIME.names


def test_publish_citations(spark, tmp_path):
    spark.createDataFrame(
        [("f", "c", 2000, "t", 1, "x", "altro")],
        "fonte_filename string, fonte_collezione string, fonte_anno bigint, fonte_tipo string, articolo bigint, contesto string, extra string",
    ).write.parquet(str(tmp_path / "cit"))
    datasets.publish_citazioni(spark, str(tmp_path / "cit"), str(tmp_path / "manca"), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a" / "parquet")).columns == schemas.CITAZIONI.names[:-1]
    spark.createDataFrame([(1, "testo")], "articolo bigint, testo string").write.parquet(str(tmp_path / "art"))
    datasets.publish_citazioni(spark, str(tmp_path / "cit"), str(tmp_path / "art"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b" / "parquet")).first().articolo_testo == "testo"
