from pyspark.sql import functions as F

from lexspark import fixed, schemas
from lexspark.plans import contracts, datasets
from lexspark.sources import archives


def failed(report):
    return {r.rule for r in report.where("NOT ok").collect()}


def test_text_and_articles(spark):
    body = "# P\n" + "".join(f"## Art. {i}\ntesto\n" for i in range(1, 140))
    final = f"# {fixed.FINAL_PART}\n" + "".join(f"### {n}\nx\n" for n in ("I", "II", "III", "IV", "V", "VI") * 3)
    docs = spark.createDataFrame([("c.md", fixed.FRONTMATTER + "\n" + body + final)], "documento string, value string")
    assert failed(contracts.testo(docs)) == set()
    articles = datasets.articoli(docs, "value", ())
    assert failed(contracts.articoli(schemas.select_as(articles, schemas.ARTICOLI))) == set()
    assert failed(contracts.testo(docs.withColumn("value", F.concat("value", F.lit("### VII<br>"))), provisions=20)) == {
        "provisions", "value free of <ref>|<br"}
    assert failed(contracts.articoli(articles.where("articolo <> 32"))) == {"rows", "articolo not null", "articolo has 32"}


def test_mapping_and_revisions(spark):
    entries = spark.createDataFrame([(0, 9, "a", "d", "outcome"), (1, 3, "b", "", "altro")], "ordinal bigint, articolo bigint, dataset_slug string, dimensione string, tipo string")
    registry = spark.createDataFrame([("a",)], "dataset_slug string")
    assert failed(contracts.mapping(entries, registry)) == {"dimensione not empty", "tipo in domain", "dataset_slug references", "schema_version is 1"}
    assert "schema_version is 1" not in failed(contracts.mapping(entries.withColumn("schema_version", F.lit(1)), registry))
    assert "schema_version is 1" in failed(contracts.mapping(entries.withColumn("schema_version", F.col("ordinal")), registry))
    laws = spark.createDataFrame([("u", "c", "d", "t", [9], 1, fixed.AMENDMENT)], schemas.REVISIONI)
    assert failed(contracts.revisioni(laws, rows=1, amendments=1)) == set()
    assert failed(contracts.revisioni(laws)) == {"rows", "amendments"}


def test_unpacked_xml_files(spark, tmp_path):
    act = "<atto anno='2020' numero='{0}'><numero_parte>2<parametri><parametro><descrizione>Costituzione</descrizione><articolo>{0}</articolo></parametro></parametri></numero_parte></atto>"
    (tmp_path / "r.xml").write_text("<registro>" + "".join(act.format(i) for i in (3, 9)) + "</registro>", encoding="utf-8")
    rows = datasets.flatten.flatten_acts(archives.acts_from_files(spark, str(tmp_path / "r.xml")), F.lit("ricorso"))
    assert sorted((r.tipo, r.numero_parte, r.parametro_articolo) for r in rows.collect()) == [("ricorso", 2, 3), ("ricorso", 2, 9)]
    ruling = "<pronuncia><pronuncia_testata><anno_pronuncia>1960</anno_pronuncia></pronuncia_testata><massime><massima><numero>1</numero><testo>non fondata</testo></massima></massime></pronuncia>"
    (tmp_path / "m.xml").write_text(f"<a><b>{ruling}</b></a>", encoding="utf-8")
    maxims = datasets.flatten.flatten_maxims(archives.rulings_from_files(spark, str(tmp_path / "m.xml")))
    assert [(r.anno_pronuncia, r.id_massima, r.esito) for r in maxims.collect()] == [(1960, 1, "non_fondata")]
