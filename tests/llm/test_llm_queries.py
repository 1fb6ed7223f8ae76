"""The registered queries of the subpackage against their SQL on the small tables."""

import os

import oracle
import pytest

from lexspark.llm import langid
from lexspark.llm.queries import CATALOG, trained_language_model

ROOT = os.environ.get("TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
NATIVE = ("op1_chat_windows", "op4_quality_ledger", "op6_secrets", "op9_line_dedup")


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql))
def test_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.database(ROOT), CATALOG[name].run, CATALOG[name].sql, ROOT) > 0


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_native_plans(spark, name):
    plan = CATALOG[name].run(spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["op5_simhash", "op7_bpe", "op9_line_dedup", "op10_language", "op11_token_alignment"])
def test_every_document_is_there(spark, name):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    got = CATALOG[name].run(spark, ROOT)
    assert got.select("doc_id").distinct().count() == docs.count()
    if name != "op9_line_dedup":
        assert got.count() == docs.count()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    rows = CATALOG["op10_language"].run(spark, ROOT).join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out AND length(text) > 40").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_model_reads_no_other_column(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    model = trained_language_model(docs)
    texts = [r["text"] for r in docs.limit(20).collect()]
    assert isinstance(model, langid.Model) and model.predict(texts)[0] == model.predict(texts)[0]
