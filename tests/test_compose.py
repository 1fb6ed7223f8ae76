"""Archives and XML files that stand in for real ones: what they hold in memory and on disk."""

import datetime
import xml.etree.ElementTree as ElementTree
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from lexspark.plans import catalog, compose
from lexspark.sources import shred


class Rows:
    """Stands in for a table: hands out the function that Spark would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_archives_are_packed_one_at_a_time():
    held = []

    def build(xml):
        held.append(xml)
        return b"x" * (1 << 20)

    run = compose.pack(Rows(), build)
    names = ["a.zip" if k % 2 else "b.zip" for k in range(2600)]
    batch = pa.RecordBatch.from_pydict({"folder": [str(k) for k in range(2600)], "archive": names, "xml": [f"<{k}/>" for k in range(2600)]})
    made, out = run(iter([batch])), []
    first = next(made)
    assert len(held) < 26 and first.nbytes < 5 << 20
    out = [r["archive"] for b in (first, *made) for r in b.to_pylist()]
    assert out == [f"{k}/{n}" for n, start in (("b.zip", 0), ("a.zip", 1)) for k in range(start, 2600, 200)]
    assert "".join(held) == "".join(f"<{k}/>" for start in (0, 1) for k in range(start, 2600, 2))


def orders(spark, n):
    day = datetime.datetime(2001, 2, 3)
    return spark.createDataFrame([(k, k * 7, day, "1-URGENT") for k in range(n)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string")


def test_xml_has_no_white_space_of_its_own(spark):
    one = F.struct(F.struct(F.lit(" a\n b").alias("testo"), F.lit("").alias("vuoto")).alias("figlio"))
    assert spark.range(1).select(compose.xml_of(one, "r").alias("x")).first()["x"].rstrip("\n") == "<r><figlio><testo> a\n b</testo><vuoto></vuoto></figlio></r>"


def test_xml_files_take_a_fraction_of_their_text(spark, tmp_path, monkeypatch):
    orders(spark, 3000).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(catalog, "shared_dir", lambda session, name: str(tmp_path / name))
    rows = catalog.CATALOG["xml_files"].run(spark, str(tmp_path)).count()
    assert rows == catalog.CATALOG["maxim_cross"].run(spark, str(tmp_path)).count() > 3000
    table = orders(spark, 3000)
    text = table.select(F.sum(F.octet_length(catalog._ruling_xml(table)))).first()[0]
    assert sum(f.stat().st_size for f in Path(tmp_path / "xml").glob("part-*")) < text / 4


def test_leaves_of_any_order_and_number():
    leaves = shred.Leaves("a", "b", "c")
    for xml in ("<r><a>1</a><b>2</b><c/></r>", "<r><c>3</c><a>1</a><a>no</a></r>", "<r/>", "<r><a>1</a><b>2<i/>no</b><c>3</c><d/></r>", "<r><b/></r>"):
        leaves.add(ElementTree.fromstring(xml))
    # One list however many names, and nothing is looked for by name where the children are those expected.
    assert leaves.values == ["1", "2", "", "1", None, "3", None, None, None, "1", "2", "3", None, "", None]
    leaves.cut(3)
    assert leaves.take().to_pylist() == [{"a": "1", "b": "2", "c": ""}, {"a": "1", "b": None, "c": "3"}, {"a": None, "b": None, "c": None}]
    leaves.add(ElementTree.fromstring("<r><a>4</a></r>"))
    assert leaves.take().to_pylist() == [{"a": "4", "b": None, "c": None}]
