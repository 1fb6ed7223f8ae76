from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions import markup
from lexspark.plans import datasets

OPENING = "intro\n" + fixed.PROMULGATION


def run(spark, step, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in rows.select("i", step(F.col("x")).alias("y")).orderBy("i").collect()]


def test_crop(spark):
    assert run(
        spark, markup.crop,
        f"{OPENING}\n\n uno \n", f"{OPENING} \xa0\n\n\nuno {fixed.PROMULGATION}\ndue", f"{OPENING} uno|}}due",
        "{|a|} uno ", "|}uno", " uno ", "",
    ) == ["uno", f"uno {fixed.PROMULGATION}\ndue", "due", "uno", "|}uno", "uno", ""]


def test_clean(spark):
    assert run(
        spark, markup.clean,
        "a{{x\ny}}b", "a{{x{{y}}z}}b", "a{|x\n|y|}b", "[[Voce|altro]] e [[Pagina]]", "a<br>b<BR />c<br/>d",
        "a<ref name='x'>n\nn</ref>b", "a<ref/>b<ref>c</ref>d", "<i>a</i> <b\nc>", "a   b\n\n", "\n\n a",
    ) == [
        "ab", "az}}b", "ab", "Voce e Pagina", "a\nb\nc\nd", "ab", "ad", "a ", "a b\n\n", " a",
    ]


def test_headings_first_rule_wins(spark):
    assert run(
        spark, markup.headings,
        "=====Art. 1=====", "===== Art. 12-bis ===== ", "==== Sezione I ====", "=== Titolo ===", "== '''Parte''' ==",
        "==Parte==", "=====x=====", "==== # no ====", "testo == x ==", "= uno =", "a\n  == b ==  \n\t\nc",
    ) == [
        "## Art. 1", "## Art. 12-bis", "### Sezione I", "## Titolo", "# Parte",
        "# Parte", "### =x=", "###  # no", "testo == x ==", "= uno =", "a\n# b\n\nc",
    ]


def test_normalize(spark):
    assert run(
        spark, markup.normalize,
        "a\n\n\n\n\nb", "a\nCategoria:x\nb\nCategoria:y", "===== = I = =====", "=====  == I ==  =====\n\ntesto", "'''g''' ''c'' '''''m'''''",
    ) == ["a\n\nb", "a\nb", "### I", "### = I =\ntesto", "**g** *c* ***m***"]


def test_testo_and_statistics(spark):
    page = f"{OPENING}\n\n== '''Principi''' ==\n=====Art. 1=====\nuno\n=====Art. 2=====\ndue<br/>tre\n"
    docs = datasets.testo(spark.createDataFrame([("p", page)], "file_name string, value string"))
    assert docs.first().contenuto == (
        fixed.FRONTMATTER + "\n# Principi\n## Art. 1\nuno\n## Art. 2\ndue\ntre\n"
    )
    assert tuple(datasets.testo_statistics(docs).first()) == ("p", 2, 1)
