"""Documents to segments, and frontmatter to fields.

Part, title and section nest strictly (a part resets title and section, a title resets the
section), so the running context of a segment is simply the heading of the pieces that hold it.
Splitting a text at part headings, each part at title headings, and so on therefore gives the
segments with their context in one narrow pass: no shuffle, no sort, no window, and the cost is
linear in the text whatever its number of headings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.text import count_paragraphs, digits_or, or_empty, strip


def _first_line(piece: Column) -> Column:
    return F.substring_index(piece, "\n", 1)


def _label(piece: Column, heading: str) -> Column:
    """Captured label if the piece opens with ``heading``, else an empty string."""
    return F.regexp_extract(_first_line(piece), rf"(?mdU)\A{heading}", 1)


def _cut(df: DataFrame, keep: list[str], piece: str, heading: str, label: tuple[str, Column] | None,
         position: str) -> DataFrame:
    """Cut ``piece`` before every line that fits ``heading``; the label is made once per piece.

    The label has a projection of its own, below the explode. The split stays inside the explode:
    as a column it would be evaluated again by the filter Spark infers on exploded columns.
    """
    kept = keep
    if label is not None:
        df = df.select(*keep, label[1].alias(label[0]), piece)
        kept = [*keep, label[0]]
    cut = F.split(F.col(piece), rf"(?mdU)^(?={heading})", -1)
    return df.select(*kept, F.posexplode(cut).alias(position, "_next")).withColumnRenamed("_next", "_piece")


def drop_metadata_lines(text: Column) -> Column:
    prefixes = "|".join(fixed.METADATA_PREFIXES)
    return F.regexp_replace(text, rf"(?md)^(?:{prefixes})[^\n]*\n?", "")


def segment_documents(df: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per article or provision.

    Columns: ``keep``, ``ordine`` (sorts the segments of a document), ``numero`` (the article
    number as written), ``articolo``, ``disposizione``, ``parte``, ``titolo``, ``sezione``,
    ``heading``, ``testo``, ``commi``.
    """
    keys, piece = list(keep), F.col("_piece")
    parte = F.when(piece.startswith(fixed.FINAL_PART_HEADING), F.lit(fixed.FINAL_PART)).otherwise(
        _label(piece, fixed.PART_HEADING)
    )
    titolo, sezione = _label(piece, fixed.TITLE_HEADING), _label(piece, fixed.SECTION_HEADING)
    bare = df.select(*keys, drop_metadata_lines(F.col(text)).alias("_text"))
    parts = _cut(bare, keys, "_text", rf"{fixed.FINAL_PART_HEADING}|{fixed.PART_HEADING}", None, "_p")
    titles = _cut(parts, [*keys, "_p"], "_piece", fixed.TITLE_HEADING, ("parte", parte), "_t")
    sections = _cut(titles, [*keys, "_p", "parte", "_t"], "_piece", fixed.SECTION_HEADING, ("titolo", titolo), "_s")
    pieces = _cut(sections, [*keys, "_p", "parte", "_t", "titolo", "_s"], "_piece",
                  rf"{fixed.ARTICLE_HEADING}|{fixed.PROVISION_HEADING}", ("sezione", sezione), "_a")
    numero, disposizione = _label(piece, fixed.ARTICLE_HEADING), _label(piece, fixed.PROVISION_HEADING)
    body = F.substring(piece, F.char_length(_first_line(piece)) + 2, F.char_length(piece))
    labelled = pieces.where((numero != "") | (disposizione != "")).select(
        *keys,
        F.struct("_p", "_t", "_s", "_a").alias("ordine"),
        F.nullif(numero, F.lit("")).alias("numero"),
        F.nullif(disposizione, F.lit("")).alias("disposizione"),
        "parte", "titolo", "sezione",
        strip(body).alias("testo"),
    )
    return _segment_columns(labelled, keys)


def _segment_columns(labelled: DataFrame, keys: list[str]) -> DataFrame:
    return labelled.select(
        *keys, "ordine", "numero",
        digits_or(F.col("numero"), None).alias("articolo"),
        "disposizione", "parte", "titolo", "sezione",
        F.coalesce(
            F.concat(F.lit(fixed.ARTICLE_LABEL), F.col("numero")),
            F.concat(F.lit(fixed.PROVISION_LABEL), F.col("disposizione")),
        ).alias("heading"),
        "testo",
        count_paragraphs(F.col("testo")).alias("commi"),
    )


# --- documents larger than a cell --------------------------------------------------------------
# What a line does to the running context is to set some of part, title, section and open segment: a
# part empties title and section, a title the section, each of them closes the segment. So the context
# after any run of lines is, field by field, the last that was set, and what one split leaves behind is
# put together with what the splits before it left.
_CONTEXT = ("_parte", "_titolo", "_sezione", "_open")


def _sets(line: Column, place: Column) -> list[Column]:
    """What a line sets of the context, null where it sets nothing; a closed segment has no place."""
    final = line.startswith(fixed.FINAL_PART_HEADING)
    part = F.when(final, F.lit(fixed.FINAL_PART)).otherwise(F.nullif(_label(line, fixed.PART_HEADING), F.lit("")))
    title, section = (F.nullif(_label(line, h), F.lit("")) for h in (fixed.TITLE_HEADING, fixed.SECTION_HEADING))
    opens = line.rlike(rf"(?mdU)\A(?:{fixed.ARTICLE_HEADING}|{fixed.PROVISION_HEADING})")
    closed = F.struct(F.lit(None).cast("bigint").alias("split"), F.lit(None).cast("bigint").alias("at"))
    over = part.isNotNull()
    return [
        part.alias("_parte"),
        F.when(over, F.lit("")).otherwise(title).alias("_titolo"),
        F.when(over | title.isNotNull(), F.lit("")).otherwise(section).alias("_sezione"),
        F.when(opens, place).when(over | title.isNotNull() | section.isNotNull(), closed).alias("_open"),
    ]


def segment_lines(lines: DataFrame, doc: str = "file_name", split: str = "split", at: str = "at", text: str = "line") -> DataFrame:
    """The rows of ``segment_documents`` for documents that come line by line, in splits, with ``doc`` kept.

    ``split`` and ``at`` are integers: the lines of a document go by split, and within one by ``at``, once each.
    A split is sorted by one task and a segment is put together by one; a document may have any number of
    either. ``ordine`` is the place of the heading.
    """
    prefixes = "|".join(fixed.METADATA_PREFIXES)
    line = F.col("_line")
    rows = lines.select(
        F.col(doc).alias("_doc"), F.col(split).cast("bigint").alias("_split"), F.col(at).cast("bigint").alias("_at"), F.col(text).alias("_line")
    ).where(~line.rlike(rf"(?d)\A(?:{prefixes})"))
    marked = rows.select("*", *_sets(line, F.struct(F.col("_split").alias("split"), F.col("_at").alias("at"))))
    left = marked.groupBy("_doc", "_split").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in _CONTEXT])
    before = Window.partitionBy("_doc").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    given = left.select("_doc", "_split", *[F.last(c, ignorenulls=True).over(before).alias(f"{c}_given") for c in _CONTEXT])
    inside = Window.partitionBy("_doc", "_split").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    known = marked.select("_doc", "_split", "_at", "_line", *[F.last(c, ignorenulls=True).over(inside).alias(c) for c in _CONTEXT]).join(given, ["_doc", "_split"])
    context = {c: F.coalesce(c, f"{c}_given") for c in _CONTEXT}
    held = known.select(
        "_doc", "_split", "_at", "_line", context["_open"].alias("_open"),
        *[F.coalesce(context[c], F.lit("")).alias(c) for c in _CONTEXT[:3]]).where(F.col("_open.at").isNotNull())
    heading = (F.col("_open.split") == F.col("_split")) & (F.col("_open.at") == F.col("_at"))
    body = F.transform(F.sort_array(F.collect_list(F.when(~heading, F.struct("_split", "_at", "_line")))), lambda x: x["_line"])
    whole = held.groupBy("_doc", "_open").agg(
        F.max(F.when(heading, F.struct("_line", *_CONTEXT[:3]))).alias("_head"), F.array_join(body, "\n").alias("_body"))
    numero, disposizione = (F.nullif(_label(F.col("_head._line"), h), F.lit("")) for h in (fixed.ARTICLE_HEADING, fixed.PROVISION_HEADING))
    return _segment_columns(whole.select(
        F.col("_doc").alias(doc), F.col("_open").alias("ordine"), numero.alias("numero"), disposizione.alias("disposizione"),
        F.col("_head._parte").alias("parte"), F.col("_head._titolo").alias("titolo"), F.col("_head._sezione").alias("sezione"), strip(F.col("_body")).alias("testo"),
    ), [doc])


# --- frontmatter -------------------------------------------------------------------------------
def frontmatter_entries(text: Column) -> Column:
    """``array<struct<key,value>>`` of the ``key: value`` lines at the head of a document."""
    head = F.regexp_extract(text, r"(?sU)\A---\s*\n(.*?)\n---", 1)
    lines = F.filter(F.transform(F.split(head, "\n", -1), strip), lambda line: F.instr(line, ":") > 0)

    def entry(line: Column) -> Column:
        colon = F.instr(line, ":")
        value = strip(F.substring(line, colon + 1, F.char_length(line)))
        return F.struct(
            strip(F.substring(line, F.lit(1), colon - 1)).alias("key"),
            F.btrim(F.btrim(value, F.lit('"')), F.lit("'")).alias("value"),
        )

    return F.transform(lines, entry)


def frontmatter_field(entries: Column, key: str) -> Column:
    """Value of ``key`` (the last one if repeated), null if the key is absent."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]


def frontmatter_map(entries: Column) -> Column:
    """``map<string,string>``; a repeated key keeps its last value whatever the session's map policy."""
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), e["key"]))
    return F.map_from_entries(last)


def with_default_title(entries: Column, file_name: Column) -> Column:
    """The title, or the file name without ``.md`` when the key is absent (not when it is empty)."""
    return F.coalesce(frontmatter_field(entries, "titolo"), F.regexp_replace(file_name, r"\.md\z", ""))


def document_fields(df: DataFrame, text: str, keys: tuple[str, ...]) -> DataFrame:
    """Frontmatter keys as columns, empty when absent; the text is read once."""
    entries = F.col("_entries")
    fields = [or_empty(frontmatter_field(entries, key)).alias(key) for key in keys]
    return df.withColumn("_entries", frontmatter_entries(F.col(text))).select(*df.columns, *fields)
