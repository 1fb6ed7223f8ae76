"""Versions, reports made while publishing, and documents under their own names."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import WriterCommitMessage

import pyarrow as pa
from lexspark import schemas
from lexspark.operators import quality
from lexspark.plans import contracts, datasets
from lexspark.sources import files, published, tables


def articles(spark, *numbers):
    return spark.createDataFrame([(n, "", "P", "T", "", f"Art. {n}", f"testo {n}", 1) for n in numbers], schemas.ARTICOLI)


def numbers(df):
    return sorted(r["articolo"] for r in df.select("articolo").collect())


def test_versions(spark, tmp_path):
    out = str(tmp_path / "articoli")
    assert published.current(spark, out) is None
    with pytest.raises(FileNotFoundError):
        published.read_table(spark, out, schemas.ARTICOLI)
    published.publish(articles(spark, 1, 2), out, schemas.ARTICOLI)
    published.publish(articles(spark, 3), out, schemas.ARTICOLI)
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == [3]
    assert numbers(published.read_twin(spark, out, schemas.ARTICOLI)) == [3]
    assert [r["number"] for r in published.versions(spark, out).orderBy("number").collect()] == [1, 2]


def test_a_job_that_dies_between_parquet_and_csv(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "articoli")
    published.publish(articles(spark, 1, 2), out, schemas.ARTICOLI)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_csv", die)
        with pytest.raises(RuntimeError, match="lost"):
            published.publish(articles(spark, 3), out, schemas.ARTICOLI)
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == numbers(published.read_twin(spark, out, schemas.ARTICOLI)) == [1, 2]
    published.publish(articles(spark, 4), out, schemas.ARTICOLI)
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == [4]


def test_the_report_comes_from_the_written_plan(spark, tmp_path):
    """The same report as a second pass would give, and the rows are made once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = articles(spark, 1, 2, 32, None)
    contract = contracts.articoli_contract(4, 3)
    counted = rows.mapInArrow(count, rows.schema)
    report = published.publish(counted, str(tmp_path / "a"), schemas.ARTICOLI, rules=contract.rules)
    assert made.value == 4
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, quality.dq_report(rows, contract.rules).collect()))
    assert report.where("ok").count() == 3


def test_a_broken_contract_is_refused(spark, tmp_path):
    out = str(tmp_path / "a")
    rules = contracts.articoli_contract(2, 2, 1).rules
    published.publish(articles(spark, 1, 2), out, schemas.ARTICOLI, rules=rules)
    with pytest.raises(published.Refused, match="rows, articolo not null") as refused:
        published.publish(articles(spark, 1), out, schemas.ARTICOLI, rules=rules)
    assert refused.value.report.where("rule = 'rows'").first()["observed"] == 1
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == [1, 2]


def test_empty_tables(spark, tmp_path):
    out = str(tmp_path / "a")
    published.publish(articles(spark, 1), out, schemas.ARTICOLI)
    none = articles(spark, 1).where("false")
    assert published.publish(none, out, schemas.ARTICOLI, when_empty="skip") is None
    with pytest.raises(ValueError, match="nothing to publish"):
        published.publish(none, out, schemas.ARTICOLI, when_empty="error")
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == [1]
    published.publish(none, out, schemas.ARTICOLI)
    assert numbers(published.read_table(spark, out, schemas.ARTICOLI)) == []


def test_documents_keep_their_names(spark, tmp_path):
    docs = [(f"legge {k} é+%41.md", f"# {k}\n\nè" if k else None) for k in range(30)]
    table = spark.createDataFrame(docs, "documento string, contenuto string").repartition(5)
    published.publish_documents(table, str(tmp_path / "d"))
    got = {r["file_name"]: r["value"] for r in published.read_documents(spark, str(tmp_path / "d")).collect()}
    assert got == {n: t for n, t in docs if t}  # Spark's readers pass over empty files
    assert len(list((tmp_path / "d").glob("v-*/legge*"))) == 30
    published.publish_documents(table.limit(2), str(tmp_path / "d"))
    assert published.read_documents(spark, str(tmp_path / "d"), "*.md").count() == 2


@pytest.mark.parametrize("names", [["a.md", "a.md"], ["a.md", None], ["a/b"], [".a"], [""]])
def test_illegal_names(spark, tmp_path, names):
    out = str(tmp_path / "d")
    published.publish_documents(spark.createDataFrame([("x", "y")], "documento string, contenuto string"), out)
    with pytest.raises(Exception, match="name"):
        published.publish_documents(spark.createDataFrame([(n, "y") for n in names], "documento string, contenuto string"), out)
    assert [r["file_name"] for r in published.read_documents(spark, out).collect()] == ["x"]


def test_a_task_that_runs_again_leaves_no_duplicates(tmp_path):
    writer = files.FilesWriter(str(tmp_path / "d"))
    batch = pa.RecordBatch.from_pydict({"name": ["a.md", "b.md"], "content": ["1", "2"]})

    def dies():
        yield batch
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    message = writer.write(iter([batch]))
    assert isinstance(message, WriterCommitMessage) and message.rows == 2
    writer.commit([message])
    assert sorted(x.name for x in (tmp_path / "d").iterdir()) == ["_SUCCESS", "a.md", "b.md"]
    writer.abort([message])
    assert not (tmp_path / "d").exists()


def test_views_show_the_current_version(spark, tmp_path):
    for n in (1, 2):
        published.publish(articles(spark, n), str(tmp_path / "articoli"), schemas.ARTICOLI)
    assert datasets.register_views(spark, str(tmp_path)) == ["articoli"]
    assert numbers(spark.table("articoli")) == [2]


def test_datasets_as_versions(spark, tmp_path):
    (tmp_path / "laws").mkdir()
    (tmp_path / "laws" / "a.md").write_text('---\nurn: u\ndata: d\ntitolo: "Modifica all\'articolo 9 della Costituzione"\n---\n')
    datasets.publish_revisioni(spark, str(tmp_path / "laws"), str(tmp_path / "out"), True, contracts.revisioni_contract(1, 1, 9))
    assert published.read_table(spark, str(tmp_path / "out"), schemas.REVISIONI).first()["articoli_modificati"] == [9]
    with pytest.raises(published.Refused, match="rows"):
        datasets.publish_revisioni(spark, str(tmp_path / "laws"), str(tmp_path / "out"), True, contracts.revisioni_contract())
    (tmp_path / "testo.wiki").write_text("{{intestazione}}\n=====Art. 1=====\nL'Italia")
    datasets.publish_testo(spark, str(tmp_path / "testo.wiki"), str(tmp_path / "testo"), versions=True)
    (page,) = published.read_documents(spark, str(tmp_path / "testo")).collect()
    assert page["file_name"] == "testo.md" and re.search("## Art. 1", page["value"])
