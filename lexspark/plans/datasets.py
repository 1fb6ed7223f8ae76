"""Builders of the seven datasets: DataFrame in, DataFrame out, nothing runs until it is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import fixed, schemas
from lexspark.functions import markup, rules
from lexspark.functions.text import or_empty
from lexspark.operators import enrich, flatten, segment
from lexspark.plans import contracts
from lexspark.sources import archives, documents, published, tables


def testo(pages: DataFrame, text: str = "value", name: str = "file_name",
          frontmatter: str = fixed.FRONTMATTER) -> DataFrame:
    """Wikitext pages to Markdown documents."""
    md = markup.with_frontmatter(markup.normalize(F.col(text)), frontmatter)
    return pages.select(F.col(name).alias("documento"), md.alias("contenuto"))


def testo_statistics(markdown: DataFrame, text: str = "contenuto") -> DataFrame:
    return markdown.select(
        "documento",
        markup.count_articles(F.col(text)).alias("articoli"),
        markup.count_parts(F.col(text)).alias("partizioni"),
    )


def articoli(markdown: DataFrame, text: str = "contenuto", keep: tuple[str, ...] = ("documento",)) -> DataFrame:
    """Markdown documents to articles and provisions."""
    return segment.segment_documents(markdown, text, keep)


def articoli_csv(articles: DataFrame) -> DataFrame:
    """CSV form: the article number as written in the heading (``12b`` is null in the typed form)."""
    number = F.substring("heading", F.lit(len(fixed.ARTICLE_LABEL) + 1), F.char_length("heading"))
    return articles.select(
        F.when(F.col("disposizione").isNull(), number).alias("articolo"), *schemas.ARTICOLI.names[1:]
    )


def revisioni(laws: DataFrame, text: str = "value", name: str = "file_name",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Markdown laws to amendments. Map-only.

    The body is scanned only for laws whose title names no article: the body expression sits in
    the other branch of a ``CASE`` and is used nowhere else.
    """
    entries = F.col("_entries")
    read = laws.select(*keep, name, text, segment.frontmatter_entries(F.col(text)).alias("_entries")).select(
        *keep, text,
        *[or_empty(segment.frontmatter_field(entries, k)).alias(k) for k in ("urn", "codice_redazionale", "data")],
        segment.with_default_title(entries, F.col(name)).alias("titolo"),
    )
    from_title = read.withColumn("_title", rules.title_numbers(F.col("titolo")))
    numbered = from_title.withColumn(
        "_numbers", F.when(F.size("_title") > 0, F.col("_title")).otherwise(rules.body_numbers(F.col(text)))
    )
    typed = numbered.withColumn("tipo", rules.law_type(F.col("titolo"), F.col("_numbers")))
    amended = F.when(F.col("tipo") == fixed.AMENDMENT, F.col("_numbers")).otherwise(rules.no_numbers())
    return typed.withColumn("articoli_modificati", amended).select(
        *keep, "urn", "codice_redazionale", "data", "titolo", "articoli_modificati",
        F.size("articoli_modificati").cast("bigint").alias("n_articoli"), "tipo",
    )


def acts_table(records: DataFrame, kinds: dict[str, str] = fixed.ARCHIVE_KINDS) -> DataFrame:
    """Acts (``archive, record``) to constitutional parameters."""
    return flatten.flatten_acts(records, archives.archive_kind(F.col("archive"), kinds))


def atti_promovimento(zips: DataFrame, kinds: dict[str, str] = fixed.ARCHIVE_KINDS) -> DataFrame:
    """Register archives (``archive, content``) to constitutional parameters."""
    known = zips.where(archives.file_name(F.col("archive")).isin(list(kinds)))
    return acts_table(archives.read_acts(known), kinds)


def massime(zips: DataFrame) -> DataFrame:
    """Maxim archives (``archive, content``), ZIP in ZIP, to maxim x parameter x norm rows."""
    return flatten.flatten_maxims(archives.read_rulings(zips))


def citazioni_legislative(citations: DataFrame, articles: DataFrame | None, order_by: Column) -> DataFrame:
    """Citations with the text of the article; of several the last by ``order_by``."""
    return enrich.add_citation_text(citations, articles, order_by)


def indicatori_costituzionali(mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Mapping with registry names; ``ordinal`` keeps the input order."""
    return enrich.add_registry(mapping, registry)


# --- jobs: read landed files, publish Parquet and CSV -------------------------------------------
# With ``versions`` a table is published as a version of its own, checked while it is written, and the
# former one stays in place until the next is whole.
def _publish(df: DataFrame, out: str, schema: T.StructType, text_form=None, when_empty: str = "write",
             versions: bool = False, contract: contracts.Contract | None = None) -> bool:
    if not versions:
        return tables.publish(df, out, schema, text_form, when_empty)
    rules = contract.rules if contract else ()
    return published.publish(df, out, schema, text_form, when_empty, rules) is not None


def publish_testo(spark: SparkSession, wikitext: str, out: str, versions: bool = False) -> None:
    made = testo(documents.read_document(spark, wikitext))
    if versions:
        named = F.concat(F.regexp_replace("documento", r"\.[^.]*$", ""), F.lit(".md"))
        published.publish_documents(made.withColumn("documento", named), out)
    else:
        documents.write_text(made, out)


def publish_articoli(spark: SparkSession, markdown: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> None:
    docs = documents.read_document(spark, markdown)
    _publish(articoli(docs, "value", ()), out, schemas.ARTICOLI, articoli_csv, "write", versions, contract)


def publish_revisioni(spark: SparkSession, corpus: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> None:
    _publish(revisioni(documents.read_documents(spark, corpus)), out, schemas.REVISIONI, None, "error", versions, contract)


def publish_atti_promovimento(spark: SparkSession, zips: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> bool:
    acts = acts_table(archives.acts_in(spark, zips, tuple(fixed.ARCHIVE_KINDS)))  # other archives are not read at all
    return _publish(acts, out, schemas.ATTI_PROMOVIMENTO, None, "skip", versions, contract)


def publish_massime(spark: SparkSession, zips: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> None:
    _publish(flatten.flatten_maxims(archives.rulings_in(spark, zips)), out, schemas.MASSIME, None, "write", versions, contract)


def publish_citazioni(spark: SparkSession, citations: str, articles: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> None:
    known = documents.if_exists(lambda: spark.read.parquet(articles).select(
        "articolo", "testo", F.struct("_metadata.file_path", "_metadata.row_index").alias("_order")))
    rows = citazioni_legislative(spark.read.parquet(citations), known, F.col("_order"))
    _publish(rows, out, rows.schema, None, "write", versions, contract)  # types are those of the upstream table


def publish_indicatori(spark: SparkSession, mapping: str, registry: str, out: str, versions: bool = False, contract: contracts.Contract | None = None) -> None:
    entries, known = tables.read_mapping(spark, mapping), tables.read_registry(spark, registry)
    enrich.require_references(entries, known)
    rows = indicatori_costituzionali(entries, known)
    # A curated list, read in order.
    _publish(rows.orderBy("articolo", "ordinal"), out, schemas.INDICATORI, None, "write", versions, contract)


DATASETS = (
    "articoli", "revisioni", "atti_promovimento", "massime", "citazioni_legislative", "indicatori_costituzionali",
)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Temp views over the published Parquet, of the current version if there are versions, so the tables can be queried with Spark SQL."""
    found = []
    for name in DATASETS:
        folder = published.current(spark, f"{root}/{name}") or f"{root}/{name}"
        table = documents.if_exists(lambda: spark.read.parquet(f"{folder}/parquet"))  # noqa: B023
        if table is not None:
            table.createOrReplaceTempView(name)
            found.append(name)
    return found
