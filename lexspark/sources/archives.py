"""XML records inside ZIP archives.

Archives arrive as ``binaryFile`` rows. The only Python code of the library runs here, on Arrow
batches: unpack, then read the records of one XML member at a time. ``from_xml`` cannot stand in
for the second step, because the registers need the first of repeated children, the text before
the first child, records at any depth and the encoding the file declares.

Members, not archives, are the unit of parallelism: the (still packed) members of an archive of
archives are spread by hash, so one archive with a large share of the data does not stay in one
task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexspark import fixed, schemas
from lexspark.sources import shred, zips
from lexspark.sources.members import batches_of, elements, first_xml, inner_archives, inner_xml, malformed, own_text

MEMBER = schemas.struct("archive", "member", ("content", T.BinaryType()))


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``(archive, content)``, one row per ZIP file; ``archive`` is its full path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(
        F.col("path").alias("archive"), "content"
    )


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def archive_kind(archive: Column, kinds: dict[str, str] = fixed.ARCHIVE_KINDS) -> Column:
    """Literal tag of an archive by its file name; null for an unknown one."""
    tag = F.lit(None).cast("string")
    for name, kind in kinds.items():
        tag = F.when(file_name(archive) == name, F.lit(kind)).otherwise(tag)
    return tag


def member_year(member: Column) -> Column:
    """First four-digit run of a member name, ``??`` without one."""
    return F.coalesce(F.nullif(F.regexp_extract(member, r"(\d{4})", 1), F.lit("")), F.lit("??"))


def _in_tasks(df: DataFrame, task: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]],
              output: T.StructType) -> DataFrame:
    schema = to_arrow_schema(output)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(task(batches), schema)

    return df.mapInArrow(run, output)


def _spread_inner(archives: DataFrame) -> DataFrame:
    """The inner archives, still packed, spread over the tasks.

    With the number of partitions given, AQE does not merge them by their packed size, which is
    far below that of the work in them.
    """
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _in_tasks(archives.select("archive", "content"), inner_archives, MEMBER)
    return packed.repartition(tasks, "archive", "member")


def nested_xml_members(archives: DataFrame) -> DataFrame:
    """Every ``.xml`` member of every ``.zip`` member; ``member`` is ``inner.zip/file.xml``."""
    return _in_tasks(_spread_inner(archives), inner_xml, MEMBER)


def malformed_members(archives: DataFrame) -> DataFrame:
    """``(archive, member)`` of the files that ``read_rulings`` leaves out."""
    return _in_tasks(_spread_inner(archives), lambda b: malformed(inner_xml(b)), schemas.struct("archive", "member"))


# --- records -----------------------------------------------------------------------------------
# Unpacking and reading share a task, so unpacked XML never leaves the worker.
def _record(shape: T.StructType) -> T.StructType:
    return schemas.struct("archive", "member", ("record", shape))




def _act() -> shred.Record:
    return shred.Record(
        anno=shred.Text(lambda e: e.get("anno", "")), numero=shred.Text(lambda e: e.get("numero", "")),
        parti=shred.Every(shred.children("numero_parte"), shred.Record(
            numero_parte=shred.Text(lambda e: e.text or ""),
            norme=shred.Every(shred.children("norma"), shred.Leaves(*schemas.ACT_NORM.names), "norme"),
            parametri=shred.Every(shred.children("parametro"), shred.Leaves(*schemas.ACT_PARAMETER.names), "parametri"),
        )))


def _ruling() -> shred.Record:
    return shred.Record(
        testata=shred.First("pronuncia_testata", shred.Leaves(*schemas.RULING_HEAD.names)),
        massime=shred.Every(shred.below("massima"), shred.Record(
            numero=shred.Text(lambda e: own_text(e, "numero")), testo=shred.Text(lambda e: own_text(e, "testo")),
            parametri=shred.Every(shred.below("parametro", "parametri"), shred.Leaves(*schemas.MAXIM_PARAMETER.names)),
            norme=shred.Every(shred.below("norma", "norme"), shred.Leaves(*schemas.MAXIM_NORM.names)),
        )))


def _records(members: DataFrame, unpack: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]], tag: str,
             any_depth: bool, fail_fast: bool, shape: shred.Record, output: T.StructType) -> DataFrame:
    schema = to_arrow_schema(_record(output))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from shred.read_records(unpack(batches), lambda xml: elements(xml, tag, any_depth), fail_fast, shape, schema)

    return members.mapInArrow(run, _record(output))


def read_acts(archives: DataFrame) -> DataFrame:
    """``(archive, member, record)`` per act directly below the root of the first XML member.

    An archive without XML is skipped; malformed XML is an error.
    """
    return _records(archives.select("archive", "content"), first_xml, "atto", False, True, _act(), schemas.ACT)


def read_rulings(archives: DataFrame) -> DataFrame:
    """``(archive, member, record)`` per ruling at any depth of the XML in the inner archives.

    A malformed file gives no rows.
    """
    return _records(_spread_inner(archives), inner_xml, "pronuncia", True, False, _ruling(), schemas.RULING)


_PACKED = ("archive", "member", "method", "crc", "content")


def acts_by_range(spark: SparkSession, path: str, glob: str = "*.zip", split: int = zips.SPLIT) -> DataFrame:
    """``read_acts`` of the archives in a folder, whatever their size."""
    found = zips.read_members(spark, path, glob, first=True, split=split)
    return _records(found.select(*_PACKED), zips.unpacked_rows, "atto", False, True, _act(), schemas.ACT)


def rulings_by_range(spark: SparkSession, path: str, glob: str = "*.zip", split: int = zips.SPLIT) -> DataFrame:
    """``read_rulings`` of the archives in a folder, whatever their size; a large inner archive is read by many tasks."""
    found = zips.read_members(spark, path, glob, inner=True, split=split)
    return _records(found.select(*_PACKED), zips.unpacked_rows, "pronuncia", True, False, _ruling(), schemas.RULING)


def acts_in(spark: SparkSession, path: str, names: Sequence[str] = ("*.zip",)) -> DataFrame:
    """The acts of the archives in a folder: by range, or as cells of at most 2 GB where only Spark reads the store."""
    if zips.reachable(path):
        return acts_by_range(spark, path, "|".join(names))
    return read_acts(read_archives(spark, path, "{" + ",".join(names) + "}"))


def rulings_in(spark: SparkSession, path: str) -> DataFrame:
    """The rulings of the archives in a folder, read as ``acts_in`` does."""
    return rulings_by_range(spark, path) if zips.reachable(path) else read_rulings(read_archives(spark, path))


# --- XML in a column or in unpacked files ------------------------------------------------------
# Columns are read by the JVM alone, which differs from the archive readers where XML is irregular: of
# repeated children it takes the last, and inline markup in a text stays in it. With ``exact`` they are
# read as archives are. Unpacked files are cut into records by Spark's text reader and always read so.
ACT_XML = schemas.struct("_anno", "_numero", ("numero_parte", T.ArrayType(schemas.struct(
    "_VALUE",
    ("norme", schemas.struct(("norma", T.ArrayType(schemas.ACT_NORM)))),
    ("parametri", schemas.struct(("parametro", T.ArrayType(schemas.ACT_PARAMETER)))),
))))
RULING_XML = schemas.struct(("pronuncia_testata", schemas.RULING_HEAD), ("massime", schemas.struct(
    ("massima", T.ArrayType(schemas.struct(
        "numero", "testo",
        ("parametri", schemas.struct(("parametro", T.ArrayType(schemas.MAXIM_PARAMETER)))),
        ("norme", schemas.struct(("norma", T.ArrayType(schemas.MAXIM_NORM)))),
    ))),
)))


def _parse_options(fail_fast: bool) -> dict[str, str]:
    return {"mode": "FAILFAST" if fail_fast else "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


def _act_record(xml: str) -> Column:
    return F.struct(
        F.col(f"{xml}._anno").alias("anno"), F.col(f"{xml}._numero").alias("numero"),
        F.transform(f"{xml}.numero_parte", lambda p: F.struct(
            p["_VALUE"].alias("numero_parte"),
            p["norme"]["norma"].alias("norme"),
            p["parametri"]["parametro"].alias("parametri"),
        )).alias("parti"),
    ).alias("record")


def _ruling_record(xml: str) -> Column:
    return F.struct(
        F.col(f"{xml}.pronuncia_testata").alias("testata"),
        F.transform(f"{xml}.massime.massima", lambda m: F.struct(
            m["numero"].alias("numero"), m["testo"].alias("testo"),
            m["parametri"]["parametro"].alias("parametri"),
            m["norme"]["norma"].alias("norme"),
        )).alias("massime"),
    ).alias("record")


def _exact(df: DataFrame, xml: str, keep: tuple[str, ...], fail_fast: bool, shape: shred.Record, output: T.StructType) -> DataFrame:
    """``(keep, record)`` of a column with an element per row, with the shapes of the archive readers."""
    rows = df.select(*keep, F.col(xml).alias("_xml"))
    made = T.StructType([*rows.schema.fields[:-1], T.StructField("record", output)])
    schema = to_arrow_schema(made)
    return rows.mapInArrow(lambda batches: shred.read_texts(batches, fail_fast, shape, schema), made)


def acts_from_column(df: DataFrame, xml: str, keep: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """``(keep, record)`` from a column with one ``<atto>`` per row; malformed XML is an error."""
    if exact:
        return _exact(df, xml, keep, True, _act(), schemas.ACT)
    parsed = df.select(*keep, F.from_xml(F.col(xml), ACT_XML, _parse_options(True)).alias("_x"))
    return parsed.select(*keep, _act_record("_x"))


def rulings_from_column(df: DataFrame, xml: str, keep: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """``(keep, record)`` from a column with one ``<pronuncia>`` per row; malformed XML has no header."""
    if exact:
        return _exact(df, xml, keep, False, _ruling(), schemas.RULING)
    parsed = df.select(*keep, F.from_xml(F.col(xml), RULING_XML, _parse_options(False)).alias("_x"))
    return parsed.select(*keep, _ruling_record("_x"))


def record_texts(spark: SparkSession, path: str, tag: str, charset: str = "UTF-8") -> DataFrame:
    """``(xml)`` of every element called ``tag`` in unpacked XML files. Files are cut at its end tags, so one of any size is read by
    many tasks. The tag must not stand within itself, nor in a comment or CDATA."""
    end = f"</{tag}>"
    pieces = spark.read.option("lineSep", end).text(path)
    text = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    # A piece lacks its end tag; without one of its own, as behind the last record, what is added closes nothing.
    found = F.regexp_extract_all(F.concat(text, F.lit(end)), F.lit(rf"(?s)<{tag}(?:\s[^<>]*)?(?:/>|(?<!/)>.*?{end})"), F.lit(0))
    return pieces.select(F.explode(found).alias("xml"))


def acts_from_files(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """``(record)`` from unpacked XML files of any size; acts are found at any depth. A malformed act is an error."""
    return acts_from_column(record_texts(spark, path, "atto", charset), "xml", exact=True)


def rulings_from_files(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """``(record)`` from unpacked XML files of any size; a malformed ruling has no header and so no rows."""
    return rulings_from_column(record_texts(spark, path, "pronuncia", charset), "xml", exact=True)
