"""Documents, laws, court records and archives composed row by row from a table's own columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexspark import schemas
from lexspark.sources.members import batches_of, pack_members


def text_of(value: Column | str) -> Column:
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def wikitext(name: Column, section: Column, number: Column) -> Column:
    """A wiki page about one customer."""
    return F.concat(
        F.lit("{{intestazione}}\n{| class=toc\n| indice\n|}\nEcco\n"),
        F.lit("la Costituzione della Repubblica Italiana nel seguente testo: \n\n\n"),
        F.lit("== '''"), name, F.lit("''' ==\n{{nota|\nx}}\n=== Titolo [[Voce|altro]] ===\n==== "), section,
        F.lit(" ====\n=====Art. "), number, F.lit("=====\n\t  testo <i>in</i> riga<br />e<BR>a capo<ref name='n'>una\nnota</ref>   fine"),
        F.lit("\n\n\n\n''corsivo'' e '''grassetto'''\n=====  = I =  =====\n== "), name, F.lit(" ==\nCategoria:Leggi\n"),
    )


def structured(doc: Column, lang: Column, source: Column, text: Column) -> Column:
    """A document whose every line becomes an article; a title opens every tenth line, a section
    every fifth, and the last line is repeated as a final provision."""
    lines = F.split(text, "\n", -1)

    def article(line: Column, i: Column) -> Column:
        return F.concat(
            F.when(i % 10 == 0, F.concat(F.lit("## Titolo "), i.cast("string"), F.lit("\n"))).otherwise(F.lit("")),
            F.when(i % 5 == 0, F.concat(F.lit("### Sezione "), i.cast("string"), F.lit("\nfuori\n"))).otherwise(F.lit("")),
            F.lit("## Art. "), (i + 1).cast("string"), F.lit("\n\n"), line, F.lit("\ndata: ieri\n\n"), line, F.lit("\n"),
        )

    return F.concat(
        F.lit("---\ntipo: PROVA\nnumero: "), doc.cast("string"), F.lit("\n---\npremessa\n# Parte "), lang, F.lit(" "), source,
        F.lit("\n"), F.array_join(F.transform(lines, article), ""),
        F.lit("# Disposizioni varie\n## Art. 7-bis\n### XIV\n"), F.element_at(lines, -1), F.lit("\n"),
    )


def law(doc: Column, lang: Column, source: Column, text: Column) -> Column:
    """A law whose articles are the lines of a document. Its title form depends on the document,
    every second article changes the constitution, every third has notes with a link to ignore."""
    number, lines = doc.cast("string"), F.split(text, "\n", -1)
    title = (
        F.when(doc % 8 == 0, F.concat(F.lit("Modifiche agli articoli "), (doc % 90 + 9).cast("string"), F.lit(", 7 e "),
                                      (doc % 50 + 3).cast("string"), F.lit(" della Costituzione.")))
        .when(doc % 8 == 1, F.concat(F.lit("Modifica all’articolo "), number, F.lit(" della Costituzione")))
        .when(doc % 8 == 2, F.concat(F.lit("REVISIONE dell'articolo "), number))
        .when(doc % 8 == 3, F.lit("Modifiche al titolo V della parte seconda della Costituzione"))
        .when(doc % 8 == 4, F.concat(F.lit("Modifica all'articolo 1 della Costituzione e Statuto  speciale "), lang))
        .when(doc % 8 == 5, F.concat(F.lit("Indizione di un Referendum "), source))
        .when(doc % 8 == 6, F.concat(F.lit("Legge "), source))
    )

    def link(n: Column) -> Column:
        ref = n.cast("string")
        return F.concat(F.lit("[art. "), ref, F.lit(" della Costituzione](/legge#art_"), ref, F.lit("~x)"))

    def article(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit("## Art. "), (i + 1).cast("string"), F.lit(".\n"), line, F.lit("\n"),
            F.when(i % 2 == 1, F.lit("è SOSTITUITO ")).otherwise(F.lit("resta ")), link(F.length(line) % 139 + 1),
            F.when(i % 3 == 0, F.concat(F.lit("\nNote \n"), link(F.lit(900)))).otherwise(F.lit("")), F.lit("\n"),
        )

    return F.concat(
        F.lit("---\nurn: urn:"), number, F.lit("\ncodice_redazionale: 0"), number, F.lit("\ndata: 2001-01-01\n"),
        F.coalesce(F.concat(F.lit('titolo: "'), title, F.lit('"\n')), F.lit("")),
        F.lit("---\n\n"), link(F.lit(901)), F.lit(" modificato\n"), F.array_join(F.transform(lines, article), ""),
    )


def _count(n: Column, build: Callable[[Column], Column]) -> Column:
    """``build`` of 0 .. n-1, an empty array for n = 0."""
    return F.transform(F.filter(F.sequence(F.lit(0), n), lambda i: i < n), build)


def act(key: Column, cust: Column, date: Column) -> Column:
    def parameter(k: Column) -> Column:
        kind = F.element_at(F.array(F.lit("Costituzione"), F.lit(" COSTITUZIONE "), F.lit("Statuto")), (k % 3 + 1).cast("int"))
        number = (cust + k) % 140
        article = F.when(number % 10 == 9, F.lit("117bis")).when(number % 11 == 10, F.lit("")).otherwise(number.cast("string"))
        return F.struct(kind.alias("descrizione"), article.alias("articolo"), k.cast("string").alias("comma"))

    def norm(k: Column) -> Column:
        return F.struct(
            F.concat(F.lit("legge "), k.cast("string")).alias("descrizione"),
            F.when(k == 0, F.lit("")).otherwise((key + k).cast("string")).alias("numero"),
            F.lit("2001").alias("data"), F.lit(" 3 ").alias("articolo"), F.lit("b").alias("comma"), F.lit("e").alias("nesso"),
        )

    def part(p: Column) -> Column:
        return F.struct(
            F.when(p == 0, F.lit("")).otherwise(p.cast("string")).alias("_VALUE"),
            F.struct(_count(((key + p) % 3).cast("int"), norm).alias("norma")).alias("norme"),
            F.struct(_count((cust % 4).cast("int"), parameter).alias("parametro")).alias("parametri"),
        )

    return F.struct(
        F.year(date).cast("string").alias("_anno"),
        F.when(key % 10 == 0, F.concat(key.cast("string"), F.lit("/A"))).otherwise(key.cast("string")).alias("_numero"),
        _count((key % 2 + 1).cast("int"), part).alias("numero_parte"),
    )


def ruling(key: Column, cust: Column, date: Column, priority: Column) -> Column:
    def maxim(m: Column) -> Column:
        text = F.element_at(F.array(
            F.lit("questione non"), F.lit("fondata nel merito"), F.lit("inammissibile"), F.lit(""), F.lit("altro testo"),
        ), ((key + m) % 5 + 1).cast("int"))
        param = lambda k: F.struct(
            F.lit("COST").alias("codice"), priority.alias("descrizione"),
            ((cust + k) % 139 + 1).cast("string").alias("articolo"), F.lit("").alias("comma"))
        norm = lambda k: F.struct(
            F.lit("L").alias("codice"), F.lit("legge").alias("descrizione"), (key + k).cast("string").alias("numero"),
            F.lit(" 2001 ").alias("data"), k.cast("string").alias("articolo"),
            F.lit("bis").alias("specificazione_articolo"), F.lit("2").alias("comma"), F.lit("").alias("specificazione_comma"))
        return F.struct(
            F.concat(F.lit(" +"), (key * 10 + m).cast("string")).alias("numero"), text.alias("testo"),
            F.struct(_count(((cust + m) % 3).cast("int"), param).alias("parametro")).alias("parametri"),
            F.struct(_count(((key + m) % 3).cast("int"), norm).alias("norma")).alias("norme"),
        )

    head = F.when(key % 17 != 0, F.struct(
        F.year(date).cast("string").alias("anno_pronuncia"),
        F.when(key % 10 == 0, F.concat(F.lit(" "), key.cast("string"))).otherwise(key.cast("string")).alias("numero_pronuncia"),
        F.lit("S").alias("tipologia_pronuncia"), F.date_format(date, "dd/MM/yyyy").alias("data_decisione"),
        F.lit("").alias("data_deposito"),
    ))
    return F.struct(head.alias("pronuncia_testata"),
                    F.struct(_count((key % 3 + 1).cast("int"), maxim).alias("massima")).alias("massime"))


def xml_of(element: Column, tag: str) -> Column:
    """An element as XML, without line breaks and indentation: nearly half of all bytes would be those."""
    return F.to_xml(element, {"rowTag": tag, "indent": ""})


_PACKED = schemas.struct("archive", ("content", T.BinaryType()))


def pack(rows: DataFrame, build: Callable[[str], bytes]) -> DataFrame:
    """``(folder, archive, xml)`` rows to ``(archive, content)`` archives of up to 100 records.

    Records are packed as they come in a batch; an archive is told from others by its folder,
    that of its first record.
    """
    schema = to_arrow_schema(_PACKED)

    def archives(batch: pa.RecordBatch) -> Iterator[dict]:
        by_name: dict[str, list[int]] = {}
        for i, name in enumerate(batch.column("archive").to_pylist()):
            by_name.setdefault(name, []).append(i)
        for name, found in by_name.items():
            for some in (found[i:i + 100] for i in range(0, len(found), 100)):
                folder, xml = batch.column("folder")[some[0]].as_py(), batch.column("xml").take(pa.array(some)).to_pylist()
                yield {"archive": f"{folder}/{name}", "content": build("".join(xml))}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One archive's texts are held beside the batch they come in, and no more archives than make up a batch of bytes.
        yield from batches_of((row for batch in batches for row in archives(batch)), schema)

    return rows.select("folder", "archive", "xml").mapInArrow(run, _PACKED)


def packers() -> tuple[Callable[[str], bytes], Callable[[str], bytes]]:
    """A register archive, and an archive of archives with one malformed member."""

    ignored = (
        '<atto anno="1" numero="1"><numero_parte><parametri><parametro><descrizione>Costituzione</descrizione>'
        "<articolo>1</articolo></parametro></parametri></numero_parte></atto>"
    )

    def register(xml: str) -> bytes:
        body = f'<?xml version="1.0" encoding="UTF-8"?><registro>\n{xml}\n<altro>{ignored}</altro></registro>'
        return pack_members([
            ("leggimi.txt", b"x"), ("registro.xml", body.encode()), ("secondo.xml", f"<r>{ignored}</r>".encode()),
        ])

    def nested(xml: str) -> bytes:
        good = f'<?xml version="1.0" encoding="ISO-8859-1"?><raccolta><anno>{xml}</anno></raccolta>'.encode("latin-1")
        broken = f"<raccolta>{xml[:xml.index('</pronuncia>') + 12]}".encode()
        return pack_members([
            ("b.zip", pack_members([("massime_2001.xml", good), ("leggimi.txt", b"x")])),
            ("a.zip", pack_members([("rotto.xml", broken)])),
            ("leggimi.txt", b"x"),
        ])

    return register, nested
