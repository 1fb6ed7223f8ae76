"""Court records: archives, malformed files, flattening."""

from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from lexspark import fixed, schemas
from lexspark.plans import datasets
from lexspark.sources import archives, members, shred
from lexspark.sources.members import pack_members

ORDINANZE, RICORSI = fixed.ARCHIVE_KINDS

ACTS = """<?xml version="1.0"?><registro_ordinanze>
<atto anno="2020" numero="7"><numero_parte> 2
  <norme>
    <norma><descrizione> legge </descrizione><numero>10</numero><data>d</data><articolo>3</articolo><comma>1</comma><nesso/></norma>
    <norma><descrizione>codice</descrizione><articolo>5</articolo></norma>
  </norme>
  <parametri>
    <parametro><descrizione>COSTITUZIONE</descrizione><articolo> 3 </articolo><comma>2</comma></parametro>
    <parametro><descrizione>Costituzione</descrizione><articolo>117bis</articolo></parametro>
    <parametro><descrizione>Costituzione</descrizione><articolo> </articolo></parametro>
    <parametro><descrizione>Statuto</descrizione><articolo>4</articolo></parametro>
  </parametri>coda</numero_parte>
  <numero_parte><parametri><parametro><descrizione>Costi<!-- x -->tuzione</descrizione><articolo>24<b>9</b>7</articolo>
    <articolo>25</articolo></parametro></parametri></numero_parte>
  <numero_parte>3<norme/></numero_parte>
</atto>
<atto anno="MM"><numero_parte>x<norme/><parametri><parametro><descrizione>costituzione</descrizione><articolo>1</articolo></parametro></parametri></numero_parte></atto>
<gruppo><atto anno="1"><numero_parte><parametri><parametro><descrizione>costituzione</descrizione><articolo>99</articolo></parametro></parametri></numero_parte></atto></gruppo>
</registro_ordinanze>"""

HEAD = (
    "<pronuncia_testata><anno_pronuncia>{}</anno_pronuncia><numero_pronuncia>{}</numero_pronuncia>"
    "<tipologia_pronuncia>S</tipologia_pronuncia><data_decisione> 1/1 </data_decisione></pronuncia_testata>"
)


def maxim(number, text, params=(), norms=()):
    return (
        f"<massima><numero>{number}</numero><testo>{text}</testo>"
        f"<parametri>{''.join(f'<parametro><articolo>{p}</articolo></parametro>' for p in params)}</parametri>"
        f"<gruppo><norme>{''.join(f'<norma><numero>{n}</numero></norma>' for n in norms)}</norme></gruppo></massima>"
    )


def rulings(*bodies):
    return f"<raccolta><anno>{''.join(f'<pronuncia>{b}</pronuncia>' for b in bodies)}</anno></raccolta>"


def save(folder, **files):
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return str(folder)


def test_acts(spark, tmp_path):
    zips = save(tmp_path, **{
        ORDINANZE: pack_members([("a.txt", b"x"), ("r.xml", ACTS.encode()), ("s.xml", ACTS.encode())]),
        RICORSI: pack_members([("senza.txt", b"")]),
        "altro.zip": pack_members([("r.xml", b"<rotto>")]),
    })
    rows = datasets.atti_promovimento(archives.read_archives(spark, zips))
    assert rows.schema.names == schemas.ATTI_PROMOVIMENTO.names
    assert [tuple(r) for r in rows.collect()] == [
        ("ordinanza", 2020, 7, 2, 3, "2", "legge", "10", "3", "legge n.10 art.3 c.1; codice art.5 c.", 2),
        ("ordinanza", 2020, 7, 2, 0, "", "legge", "10", "3", "legge n.10 art.3 c.1; codice art.5 c.", 2),
        ("ordinanza", 2020, 7, 1, 24, "", "", "", "", "", 0),
        ("ordinanza", 0, 0, 1, 1, "", "", "", "", "", 0),
    ]


def test_publish_reads_known_archives_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    zips = save(tmp_path / "in", **{ORDINANZE: pack_members([("r.xml", ACTS.encode())]), "altro.zip": b"not a zip"})
    assert datasets.publish_atti_promovimento(spark, zips, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "parquet")).count() == 4


def test_malformed_register_is_an_error(spark, tmp_path):
    zips = save(tmp_path, **{RICORSI: pack_members([("r.xml", b"<registro><atto></registro>")])})
    with pytest.raises(Exception, match="mismatched tag"):
        datasets.atti_promovimento(archives.read_archives(spark, zips)).collect()


def test_maxims(spark, tmp_path):
    good = rulings(
        HEAD.format("1960", "7") + "<massime>" + maxim("1", "questione non", [3, 24], [10, 11])
        + maxim(" +2 ", "fondata è <i>x</i>inammissibile", [3]) + maxim("x", "", (), [5]) + maxim("", "") + "</massime>",
        "<massime>" + maxim("9", "senza testata") + "</massime>",
        HEAD.format(" 1961", "8b") + maxim("4", "Sì, però è manifestamente") ,
    )
    latin = ('<?xml version="1.0" encoding="ISO-8859-1"?>' + rulings(HEAD.format("1970", "1") + maxim("5", "illegittimità: costituzionalmente illegittimità", ["à"], [1]))).encode("latin-1")
    zips = save(tmp_path, **{
        "CC_1956.zip": pack_members([
            ("b.zip", pack_members([("m_1960.xml", good.encode()), ("m.txt", b"x"), ("m_1961.xml", good[:-3].encode())])),
            ("a.zip", pack_members([("m_1970.xml", latin), ("vuoto.xml", b"")])), ("sciolto.xml", good.encode()),
        ]),
    })
    read = archives.read_archives(spark, zips)
    table = datasets.massime(read)
    assert table.schema.names == schemas.MASSIME.names
    rows = {tuple(r[c] for c in (
        "id_massima", "anno_pronuncia", "numero_pronuncia", "esito", "parametro_articolo", "norma_numero", "data_decisione",
    )) for r in table.collect()}
    assert rows == {
        (1, 1960, 7, "non_fondata", "3", "10", " 1/1 "), (1, 1960, 7, "non_fondata", "3", "11", " 1/1 "),
        (1, 1960, 7, "non_fondata", "24", "10", " 1/1 "), (1, 1960, 7, "non_fondata", "24", "11", " 1/1 "),
        (0, 1960, 7, "non_fondata", "", "", " 1/1 "),
        (4, 0, 0, "manifestamente_infondata", "", "", " 1/1 "),
        (5, 1970, 1, "illegittimo", "à", "1", " 1/1 "),
    }
    assert table.count() == 7
    found = archives.nested_xml_members(read)
    assert {r.member for r in archives.malformed_members(read).collect()} == {"b.zip/m_1961.xml", "a.zip/vuoto.xml"}
    years = found.select(archives.member_year(F.substring_index("member", "/", -1))).collect()
    assert {r[0] for r in years} == {"1960", "1961", "1970", "??"}


def test_streaming_reads_the_same_elements():
    xml = b"<r><a><p n='1'><p n='2'/></p></a><p n='3'>x</p><q>y</q><p n='4'/></r>"
    root = ElementTree.fromstring(xml)
    for any_depth in (True, False):
        tree = [e.get("n") for e in root.findall(".//p" if any_depth else "p")]
        for whole in (0, 1 << 20):
            assert sorted(tree) == sorted(e.get("n") for e in members.elements(xml, "p", any_depth, whole))
    assert tree == ["3", "4"]


def test_packed_members_of_one_archive_spread(spark):
    """One archive holds everything: its members still go to several tasks."""
    inner = [(f"{i}.zip", pack_members([("m.xml", rulings(HEAD.format(1, i)).encode())])) for i in range(40)]
    one = spark.createDataFrame([("uno.zip", bytearray(pack_members(inner)))], "archive string, content binary")
    spread = archives.nested_xml_members(one).select("member", F.spark_partition_id().alias("p"))
    assert spread.count() == 40
    assert spread.select("p").distinct().count() > 1


def test_columns_and_archives_agree(spark):
    xml = "<atto anno='2020' numero='7'><numero_parte>2<norme><norma><descrizione>l</descrizione></norma></norme><parametri><parametro><descrizione>Costituzione</descrizione><articolo>3</articolo></parametro></parametri></numero_parte></atto>"
    from_column = archives.acts_from_column(spark.createDataFrame([(xml,)], "xml string"), "xml")
    packed = spark.createDataFrame(
        [("a.zip", bytearray(pack_members([("m.xml", f"<r>{xml}</r>".encode())])))], "archive string, content binary")
    flat = [
        [tuple(r) for r in datasets.flatten.flatten_acts(df, F.lit("t")).collect()]
        for df in (from_column, archives.read_acts(packed).select("record"))
    ]
    assert flat[0] == flat[1] == [("t", 2020, 7, 2, 3, "", "l", "", "", "l art. c.", 1)]


def test_records_in_batches(spark, monkeypatch):
    """Typed columns begin anew with every batch, and a file that turns out malformed takes its records with it."""
    schema = archives.to_arrow_schema(archives._record(schemas.RULING))
    good, broken = (rulings(*[HEAD.format(k, k) + maxim(k, "t", [k], [k, k]) for k in range(n)]) for n in (5, 3))
    files = [{"archive": "a", "member": str(k), "content": c.encode()} for k, c in enumerate([good, broken[:-4], good, "<r/>", broken])]
    want = ["0"] * 5 + ["2"] * 5 + ["4"] * 3
    for size in (1, 4, 100):
        monkeypatch.setattr(shred, "_BATCH", size)
        for whole in (0, 1 << 20):
            read = lambda xml: members.elements(xml, "pronuncia", True, whole)  # noqa: B023,E731
            rows = [r for b in shred.read_records(files, read, False, archives._ruling(), schema) for r in b.to_pylist()]
            assert [r["member"] for r in rows] == want
            assert rows[4]["record"]["massime"][0]["norme"][1]["numero"] == "4"
            assert rows[-1]["record"]["testata"]["anno_pronuncia"] == "2"


IRREGULAR = [
    "<pronuncia><pronuncia_testata><anno_pronuncia>19<b>9</b>7</anno_pronuncia><anno_pronuncia>2000</anno_pronuncia><numero_pronuncia/><numero_pronuncia>5</numero_pronuncia></pronuncia_testata>"
    "<massime><massima><numero>1</numero><numero>2</numero><testo>x &lt; y &amp; <i>inammissibile</i>\nfine</testo><testo>fondata</testo>"
    "<parametri><parametro><articolo><b>3</b>4</articolo><comma>1<!-- c -->2</comma></parametro></parametri><parametri><parametro><articolo>5</articolo></parametro></parametri>"
    "<norme><norma><numero> 7 </numero><numero>8</numero></norma></norme></massima></massime></pronuncia>",
    "<pronuncia/>",
    "<pronuncia nota='a/b'><pronuncia_testata>x<anno_pronuncia>1970</anno_pronuncia></pronuncia_testata><gruppo><massima><testo>è</testo></massima></gruppo></pronuncia>",
]


def test_files_and_archives_agree(spark, tmp_path):
    """Repeated children, inline markup, empty elements, comments and entities; files cut by many tasks."""
    xml = f"<raccolta>\n<a>{''.join(IRREGULAR * 40)}</a>\n<pronuncia />coda</raccolta>"
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "m.xml").write_text(xml, encoding="utf-8")
    (tmp_path / "l.xml").write_text(xml, encoding="latin-1")
    packed = spark.createDataFrame([("a.zip", bytearray(pack_members([("b.zip", pack_members([("m.xml", xml.encode())]))])))], "archive string, content binary")
    text = lambda df: sorted(str(r["record"]) for r in df.collect())
    want = text(archives.read_rulings(packed))
    assert len(want) == 121
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        files = archives.rulings_from_files(spark, str(tmp_path / "f"))
        assert files.rdd.getNumPartitions() > 4
        assert text(files) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert text(archives.rulings_from_files(spark, str(tmp_path / "l.xml"), "ISO-8859-1")) == want
    assert text(archives.rulings_from_column(spark.createDataFrame([(x,) for x in IRREGULAR * 40 + ["<pronuncia/>"]], "x string"), "x", exact=True)) == want
    column = spark.createDataFrame([(1, "<pronuncia>"), (2, None)], "k long, x string")
    assert [r["record"]["testata"] for r in archives.rulings_from_column(column, "x", ("k",), exact=True).collect()] == [None, None]


def test_act_files_and_archives_agree(spark, tmp_path):
    (tmp_path / "r.xml").write_text(ACTS, encoding="utf-8")
    packed = spark.createDataFrame([("a.zip", bytearray(pack_members([("m.xml", ACTS.encode())])))], "archive string, content binary")
    text = lambda df: sorted(str(r["record"]) for r in df.collect())
    files = text(archives.acts_from_files(spark, str(tmp_path)))
    assert set(text(archives.read_acts(packed))) < set(files) and len(files) == 3  # one lies deeper
    (tmp_path / "r.xml").write_text("<r><atto><x></atto></r>")
    with pytest.raises(Exception, match="mismatched tag"):
        archives.acts_from_files(spark, str(tmp_path)).collect()
