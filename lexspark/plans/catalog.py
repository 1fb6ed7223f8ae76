"""Registered queries: every operator over the relational tables, each with the SQL it must equal.

Where the tables lack a shape (wikitext, Markdown law, court XML, archives), it is composed row by
row from a table's own columns and whole texts, so the work grows with the table and nothing is
gathered to make the input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import schemas
from lexspark.functions import markup, rules
from lexspark.functions.text import join_numbers, numbers_in
from lexspark.operators import enrich, flatten, metrics, quality, segment, verdicts
from lexspark.plans import compose, datasets, questions
from lexspark.session import shared_dir, spread
from lexspark.sources import archives, documents, published, tables


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def _query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        CATALOG[name] = Query(run, sql)
        return run

    return register


_SCHEMAS: dict[str, T.StructType] = {}


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table; its schema is looked up in the files once, not by a job for every query."""
    path = f"{root}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _wide(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows are work: whole texts, composed documents."""
    return spread(_table(spark, root, name), columns)


# --- counts, shares, rates ---------------------------------------------------------------------
@_query("count_by_key_desc", """
    SELECT user_id AS parametro_articolo, count(*) AS volte FROM events GROUP BY 1 ORDER BY 2 DESC, 1
""")
def _count_by_key_desc(spark: SparkSession, root: str) -> DataFrame:
    return questions.most_invoked(_table(spark, root, "events").withColumnRenamed("user_id", "parametro_articolo"))


@_query("count_by_type", "SELECT event_type, count(*) AS volte FROM events GROUP BY 1 ORDER BY 1")
def _count_by_type(spark: SparkSession, root: str) -> DataFrame:
    return metrics.count_by(_table(spark, root, "events"), "event_type").orderBy("event_type")


@_query("top5_keys", "SELECT user_id, count(*) AS volte FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _top5_keys(spark: SparkSession, root: str) -> DataFrame:
    return metrics.top(_table(spark, root, "events"), "user_id")


@_query("rate_having", """
    SELECT user_id, count(*) FILTER (event_type = 'purchase') * CAST(100 AS DOUBLE) / count(*) AS pct
    FROM events GROUP BY 1 HAVING count(*) > 65
""")
def _rate_having(spark: SparkSession, root: str) -> DataFrame:
    return metrics.rate(_table(spark, root, "events"), "user_id", F.col("event_type") == "purchase", 65)


def _rulings(spark: SparkSession, root: str) -> DataFrame:
    """Orders as rulings of their customer: status decides the outcome."""
    esito = (
        F.when(F.col("o_orderstatus") == "F", "illegittimo")
        .when(F.col("o_orderstatus") == "O", "non_fondata").otherwise("altro")
    )
    return _table(spark, root, "orders").select(compose.text_of("o_custkey").alias("parametro_articolo"), esito.alias("esito"))


_RULINGS = """
    rulings AS (SELECT CAST(o_custkey AS VARCHAR) AS parametro_articolo,
        CASE o_orderstatus WHEN 'F' THEN 'illegittimo' WHEN 'O' THEN 'non_fondata' ELSE 'altro' END AS esito FROM orders)
"""


@_query("acceptance_rate", f"""
    WITH {_RULINGS}
    SELECT parametro_articolo,
        SUM(CASE WHEN esito = 'illegittimo' THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) / COUNT(*) AS pct
    FROM rulings GROUP BY 1 HAVING COUNT(*) > 5 ORDER BY 2 DESC, 1
""")
def _acceptance_rate(spark: SparkSession, root: str) -> DataFrame:
    return metrics.acceptance_rate(_rulings(spark, root), 5)


@_query("most_accepted", f"""
    WITH {_RULINGS}
    SELECT parametro_articolo, count(*) AS volte FROM rulings WHERE esito = 'illegittimo' GROUP BY 1 ORDER BY 2 DESC, 1
""")
def _most_accepted(spark: SparkSession, root: str) -> DataFrame:
    return questions.most_accepted(_rulings(spark, root))


@_query("outcomes_by_key", f"""
    WITH {_RULINGS}
    SELECT parametro_articolo, count(*) FILTER (esito = 'illegittimo') AS accolte,
        count(*) FILTER (esito = 'non_fondata') AS respinte, count(*) AS totale
    FROM rulings GROUP BY 1
""")
def _outcomes_by_key(spark: SparkSession, root: str) -> DataFrame:
    return questions.outcomes(_rulings(spark, root))


@_query("share_of_total", """
    SELECT event_type AS esito, count(*) AS n, count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER () AS pct
    FROM events GROUP BY 1
""")
def _share_of_total(spark: SparkSession, root: str) -> DataFrame:
    return metrics.shares(_table(spark, root, "events").withColumnRenamed("event_type", "esito"), "esito")


@_query("distinct_totals", """
    SELECT count(*) AS righe, count(DISTINCT (user_id, event_type)) AS pronunce, count(DISTINCT user_id) AS massime,
        count(*) FILTER (event_type <> 'view') AS con_esito,
        count(*) FILTER (event_type <> 'view') * CAST(100 AS DOUBLE) / count(*) AS pct_con_esito
    FROM events
""")
def _distinct_totals(spark: SparkSession, root: str) -> DataFrame:
    return metrics.totals(_table(spark, root, "events"), ("user_id", "event_type"), "user_id",
                          F.col("event_type") != "view")


@_query("conditional_counts", """
    SELECT count(*) FILTER (event_type = 'click') AS modifiche, count(*) FILTER (event_type = 'view') AS statuti,
        count(*) FILTER (event_type NOT IN ('click', 'view')) AS altre FROM events
""")
def _conditional_counts(spark: SparkSession, root: str) -> DataFrame:
    kind = F.col("event_type")
    return metrics.conditional_counts(_table(spark, root, "events"), {
        "modifiche": kind == "click", "statuti": kind == "view", "altre": ~kind.isin("click", "view"),
    })


@_query("covered_keys", "SELECT DISTINCT user_id FROM events ORDER BY 1")
def _covered_keys(spark: SparkSession, root: str) -> DataFrame:
    return metrics.covered_keys(_table(spark, root, "events"), "user_id")


@_query("element_counts", r"""
    SELECT try_cast(n AS BIGINT) AS articolo, count(*) AS volte
    FROM (SELECT unnest(regexp_extract_all(text, '[0-9]+')) AS n FROM documents) GROUP BY 1 ORDER BY 2 DESC, 1
""")
def _element_counts(spark: SparkSession, root: str) -> DataFrame:
    mentions = _wide(spark, root, "documents", "text").select(numbers_in(F.col("text")).alias("articoli_modificati"))
    return questions.most_amended(mentions)


# --- enrichment and key checks -----------------------------------------------------------------
@_query("enrich_snippet", """
    WITH last AS (
        SELECT conv_id, substr(text, 1, 300) AS text FROM (
            SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
            FROM conversations WHERE text <> '') WHERE rn = 1)
    SELECT event_id, user_id, coalesce(text, '') AS articolo_testo FROM events LEFT JOIN last ON user_id = conv_id
""")
def _enrich_snippet(spark: SparkSession, root: str) -> DataFrame:
    texts = _table(spark, root, "conversations").withColumnRenamed("conv_id", "user_id")
    events = _table(spark, root, "events").select("event_id", "user_id")
    return enrich.add_snippet(events, texts, "user_id", "text", F.col("turn"))


@_query("citation_text", """
    WITH last AS (SELECT conv_id, arg_max(text, turn) AS text FROM conversations WHERE text <> '' GROUP BY 1)
    SELECT CAST(l.doc_id AS VARCHAR) AS fonte_filename, CASE quality WHEN 1 THEN 'buona' ELSE 'altra' END AS fonte_collezione,
        CAST(toxic AS BIGINT) AS fonte_anno, 'etichetta' AS fonte_tipo, l.doc_id AS articolo, '' AS contesto,
        coalesce(substr(d.text, 1, 300), '') AS articolo_testo
    FROM labels l LEFT JOIN last d ON l.doc_id = d.conv_id
""")
def _citation_text(spark: SparkSession, root: str) -> DataFrame:
    citations = _table(spark, root, "labels").select(
        compose.text_of("doc_id").alias("fonte_filename"),
        F.when(F.col("quality") == 1, "buona").otherwise("altra").alias("fonte_collezione"),
        F.col("toxic").cast("bigint").alias("fonte_anno"), F.lit("etichetta").alias("fonte_tipo"),
        F.col("doc_id").alias("articolo"), F.lit("").alias("contesto"),
    )
    articles = _table(spark, root, "conversations").select(F.col("conv_id").alias("articolo"), F.col("text").alias("testo"), "turn")
    return schemas.select_as(datasets.citazioni_legislative(citations, articles, F.col("turn")), schemas.CITAZIONI)


@_query("enrich_registry_last_wins", """
    WITH registry AS (
        SELECT 'user_' || user_id AS slug, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1),
    mapping AS (
        SELECT c_custkey AS ordinal, CAST(c_nationkey AS BIGINT) AS articolo, 'user_' || (c_custkey % 200) AS dataset_slug,
            CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS dimensione,
            CASE WHEN c_acctbal < 1000 THEN 'outcome' ELSE 'strutturale' END AS tipo_indicatore
        FROM customer WHERE c_nationkey <> 0)
    SELECT ordinal, articolo, dataset_slug,
        CASE WHEN kind IS NULL OR kind = 'error' THEN dataset_slug WHEN kind = 'view' THEN NULL ELSE kind END AS dataset_name,
        CASE WHEN kind = 'click' THEN 'da ' || kind ELSE '' END AS fonte, dimensione, tipo_indicatore
    FROM mapping LEFT JOIN registry ON slug = dataset_slug
""")
def _enrich_registry(spark: SparkSession, root: str) -> DataFrame:
    """Customers as mapping entries, events as registry documents: an absent name falls back to the
    slug ('error'), a null name stays null ('view'), the last event of a slug wins."""
    customers = _table(spark, root, "customer")
    mapping = tables.clean_mapping(customers.select(
        F.col("c_custkey").alias("ordinal"), F.col("c_nationkey").alias("articolo"),
        F.concat(F.lit("user_"), F.col("c_custkey") % 200).alias("dataset_slug"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("dimensione"),
        F.when(F.col("c_acctbal") >= 1000, F.lit("strutturale")).alias("tipo"),
    ))
    kind = F.col("event_type")
    name = F.when(kind == "error", F.lit("")).when(kind == "view", F.lit(', "name": null')).otherwise(
        F.concat(F.lit(', "name": "'), kind, F.lit('"'))
    )
    source = F.when(kind == "click", F.concat(F.lit(', "source": "da '), kind, F.lit('"'))).otherwise(F.lit(""))
    entry = F.concat(F.lit('{"slug": "user_'), compose.text_of("user_id"), F.lit('"'), name, source, F.lit("}"))
    events = _wide(spark, root, "events", "event_id", "user_id", "event_type").select(
        "event_id", F.array(F.lit('{"slug": "", "name": "x"}'), entry).alias("datasets")
    )
    registry = tables.registry_entries(events, "datasets", (F.col("event_id"),))
    return enrich.add_registry(mapping, registry)


@_query("missing_keys", """
    SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def _missing_keys(spark: SparkSession, root: str) -> DataFrame:
    return enrich.missing_keys(_table(spark, root, "documents"), _table(spark, root, "labels"), "doc_id")


@_query("cited_never_litigated", """
    SELECT DISTINCT o_custkey AS articolo FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id <> 0) AND o_custkey NOT IN (SELECT conv_id FROM conversations)
""")
def _cited_never_litigated(spark: SparkSession, root: str) -> DataFrame:
    acts = _table(spark, root, "events").select(F.col("user_id").alias("parametro_articolo"))
    maxims = _table(spark, root, "conversations").select(
        compose.text_of("conv_id").alias("parametro_articolo"), F.lit("altro").alias("esito")
    )
    citations = _table(spark, root, "orders").select(F.col("o_custkey").alias("articolo"))
    return questions.cited_never_litigated(citations, acts, maxims)


@_query("without_implementing_law", """
    SELECT c_custkey AS articolo FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
""")
def _without_implementing_law(spark: SparkSession, root: str) -> DataFrame:
    articles = _table(spark, root, "customer").select(F.col("c_custkey").alias("articolo"))
    citations = _table(spark, root, "events").select(F.col("user_id").alias("articolo"))
    return questions.without_implementing_law(articles, citations)


@_query("citations_per_article", "SELECT l_partkey AS articolo, count(*) AS volte FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1")
def _citations_per_article(spark: SparkSession, root: str) -> DataFrame:
    return questions.citations_per_article(_table(spark, root, "lineitem").withColumnRenamed("l_partkey", "articolo"))


@_query("distinct_citing", "SELECT DISTINCT l_partkey AS articolo, l_suppkey AS fonte FROM lineitem")
def _distinct_citing(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "lineitem").select(
        F.col("l_partkey").alias("articolo"), F.col("l_suppkey").alias("fonte")
    ).distinct()


@_query("laws_citing", """
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS fonte_filename, l_linestatus AS fonte_collezione, CAST(l_suppkey AS BIGINT) AS fonte_anno, l_returnflag AS fonte_tipo
    FROM lineitem WHERE l_partkey = 7
""")
def _laws_citing(spark: SparkSession, root: str) -> DataFrame:
    """What cites one article: the feature looks one key up in the whole table."""
    return questions.laws_citing(_table(spark, root, "lineitem").select(
        compose.text_of("l_orderkey").alias("fonte_filename"), F.col("l_linestatus").alias("fonte_collezione"),
        F.col("l_suppkey").cast("bigint").alias("fonte_anno"), F.col("l_returnflag").alias("fonte_tipo"), F.col("l_partkey").alias("articolo"),
    ), 7)


@_query("datasets_for", """
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS dataset_slug, event_type AS dataset_name, '' AS dimensione FROM events WHERE user_id % 25 = 9
""")
def _datasets_for(spark: SparkSession, root: str) -> DataFrame:
    """Datasets of one article, with 25 articles that all events belong to."""
    return questions.datasets_for(_table(spark, root, "events").select(
        (F.col("user_id") % 25).alias("articolo"), compose.text_of("user_id").alias("dataset_slug"), F.col("event_type").alias("dataset_name"), F.lit("").alias("dimensione"),
    ), 9)


@_query("outcomes_of", "SELECT event_type AS esito, count(*) AS volte FROM events WHERE user_id % 25 = 3 GROUP BY 1")
def _outcomes_of(spark: SparkSession, root: str) -> DataFrame:
    return questions.outcomes_of(_table(spark, root, "events").select(
        (F.col("user_id") % 25).cast("string").alias("parametro_articolo"), F.col("event_type").alias("esito")), 3)


@_query("scorecard", f"""
    WITH {_RULINGS},
    acts AS (SELECT user_id AS articolo, count(*) AS n FROM events WHERE user_id <> 0 GROUP BY 1),
    maxims AS (SELECT CAST(parametro_articolo AS BIGINT) AS articolo, count(*) AS n,
        count(*) FILTER (esito = 'illegittimo') AS yes FROM rulings GROUP BY 1),
    cites AS (SELECT l_partkey AS articolo, count(*) AS n FROM lineitem GROUP BY 1),
    revs AS (SELECT try_cast(x AS BIGINT) AS articolo, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, '[0-9]+')) AS x FROM documents) GROUP BY 1),
    inds AS (SELECT conv_id AS articolo, count(*) AS n FROM conversations GROUP BY 1)
    SELECT c_custkey AS articolo, coalesce(acts.n, 0) AS invocazioni, coalesce(maxims.n, 0) AS massime,
        coalesce(maxims.yes, 0) AS accolte, coalesce(cites.n, 0) AS citazioni, coalesce(revs.n, 0) AS revisioni,
        coalesce(inds.n, 0) AS indicatori, maxims.yes * CAST(100 AS DOUBLE) / maxims.n AS pct_accolte
    FROM customer
    LEFT JOIN acts ON acts.articolo = c_custkey LEFT JOIN maxims ON maxims.articolo = c_custkey
    LEFT JOIN cites ON cites.articolo = c_custkey LEFT JOIN revs ON revs.articolo = c_custkey
    LEFT JOIN inds ON inds.articolo = c_custkey
""")
def scorecard(spark: SparkSession, root: str) -> DataFrame:
    return questions.article_scorecard(
        _table(spark, root, "customer").select(F.col("c_custkey").alias("articolo")),
        _table(spark, root, "events").select(F.col("user_id").alias("parametro_articolo")),
        _rulings(spark, root),
        _table(spark, root, "lineitem").select(F.col("l_partkey").alias("articolo")),
        _wide(spark, root, "documents", "text").select(numbers_in(F.col("text")).alias("articoli_modificati")),
        _table(spark, root, "conversations").select(F.col("conv_id").alias("articolo")),
    )


# --- markup ------------------------------------------------------------------------------------
def _sql_rewrites(start: str, rewrites: list[tuple[str, str]]) -> str:
    for pattern, replacement in rewrites:
        start = f"regexp_replace({start}, '{pattern}', {replacement}, 'g')"
    return start


_SQL_SPACE = r"[ \t\r\x0b\x0c\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{85}\x{1c}-\x{1f}]"
_SQL_STRIP = [(rf"^(?:{_SQL_SPACE}|\n)+", "''"), (rf"(?:{_SQL_SPACE}|\n)+$", "''")]
_SQL_PAGE = _sql_rewrites("html", [
    *_SQL_STRIP,
    (r"\{\{[^}]*\}\}", "''"), (r"(?s)\{\|.*?\|\}", "''"), (r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]", r"'\1'"),
    (r"(?i)<br\s*/?>", "chr(10)"), (r"(?s)<ref[^>]*>.*?</ref>", "''"), ("<[^>]+>", "''"), ("  +", "' '"),
    (rf"{_SQL_SPACE}*\n{_SQL_SPACE}*", "chr(10)"), *_SQL_STRIP,
    (r"\n\n\n+", "chr(10) || chr(10)"), (r"\nCategoria:[^\n]*", "''"),
    ("''''''([^\\n]*?)''''''", r"'**\1**'"), ("''''([^\\n]*?)''''", r"'*\1*'"),
])


@_query("markup_clean", f"SELECT page_id, {_SQL_PAGE} AS markdown FROM pages")
def _markup_clean(spark: SparkSession, root: str) -> DataFrame:
    return _wide(spark, root, "pages", "page_id", "html").select("page_id", markup.normalize(F.col("html")).alias("markdown"))


@_query("markup_headings", r"""
    SELECT c_custkey, '# ' || c_name || chr(10) || chr(10) || '## Titolo Voce' || chr(10) || '### ' || c_mktsegment || chr(10)
        || '## Art. ' || c_custkey || chr(10) || 'testo in riga' || chr(10) || 'e' || chr(10) || 'a capo fine' || chr(10) || chr(10)
        || '*corsivo* e **grassetto**' || chr(10) || '### I' || chr(10) || '# ' || c_name AS markdown,
        CAST(1 AS BIGINT) AS articoli, CAST(2 AS BIGINT) AS partizioni
    FROM customer
""")
def _markup_headings(spark: SparkSession, root: str) -> DataFrame:
    pages = _wide(spark, root, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey", compose.wikitext(F.col("c_name"), F.col("c_mktsegment"), compose.text_of("c_custkey")).alias("wikitext")
    )
    rewritten = pages.select("c_custkey", markup.normalize(F.col("wikitext")).alias("markdown"))
    return rewritten.select(
        "*", markup.count_articles(F.col("markdown")).alias("articoli"),
        markup.count_parts(F.col("markdown")).alias("partizioni"),
    )


# --- segmentation ------------------------------------------------------------------------------


_SQL_LINES = """
    lines AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i, len(string_split(text, chr(10))) AS n FROM documents)
"""
_SQL_SEGMENTS = f"""
    {_SQL_LINES},
    clean AS (SELECT *, {_sql_rewrites("line", _SQL_STRIP)} AS bare FROM lines),
    segments AS (
        SELECT doc_id, CAST(i AS BIGINT) AS articolo, CAST(NULL AS VARCHAR) AS disposizione,
            'Parte ' || lang || ' ' || source AS parte, 'Titolo ' || ((i - 1) - (i - 1) % 10) AS titolo,
            'Sezione ' || ((i - 1) - (i - 1) % 5) AS sezione, 'Art. ' || i AS heading,
            {_sql_rewrites("line || chr(10) || chr(10) || line", _SQL_STRIP)} AS testo,
            CAST(CASE WHEN bare = '' THEN 0 ELSE 2 END AS BIGINT) AS commi
        FROM clean
        UNION ALL
        SELECT doc_id, NULL, 'XIV', 'Disposizioni transitorie e finali', '', '', 'Disposizione transitoria XIV', bare,
            CASE WHEN bare = '' THEN 0 ELSE 1 END
        FROM clean WHERE i = n)
"""


def _segments(spark: SparkSession, root: str) -> DataFrame:
    docs = _wide(spark, root, "documents", "doc_id", "lang", "source", "text").select(
        "doc_id", compose.structured(F.col("doc_id"), F.col("lang"), F.col("source"), F.col("text")).alias("contenuto")
    )
    return datasets.articoli(docs, keep=("doc_id",))


@_query("segment_hierarchy", f"WITH {_SQL_SEGMENTS} SELECT * FROM segments")
def _segment_hierarchy(spark: SparkSession, root: str) -> DataFrame:
    return _segments(spark, root).select("doc_id", *schemas.ARTICOLI.names)


@_query("segment_splits", f"WITH {_SQL_SEGMENTS} SELECT * FROM segments")
def _segment_splits(spark: SparkSession, root: str) -> DataFrame:
    """The documents of ``segment_hierarchy`` line by line, in splits of 16 lines, as one that no cell holds would come."""
    docs = _wide(spark, root, "documents", "doc_id", "lang", "source", "text")
    text = compose.structured(F.col("doc_id"), F.col("lang"), F.col("source"), F.col("text"))
    cut = docs.select("doc_id", F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
    lines = cut.select("doc_id", F.floor(F.col("at") / 16).alias("split"), "at", "line")
    return segment.segment_lines(lines, "doc_id").select("doc_id", *schemas.ARTICOLI.names)


@_query("segment_totals", f"""
    WITH {_SQL_SEGMENTS} SELECT count(*) AS segmenti, CAST(sum(commi) AS BIGINT) AS commi FROM segments
""")
def _segment_totals(spark: SparkSession, root: str) -> DataFrame:
    return metrics.segment_totals(_segments(spark, root))


@_query("frontmatter_fields", r"""
    SELECT page_id, url AS urn, 'C"' || page_id AS codice_redazionale, 'ultimo' AS data, '' AS fonte,
        CASE WHEN page_id % 3 = 0 THEN 'page-' || page_id ELSE 'Pagina: ' || page_id END AS titolo
    FROM pages
""")
def _frontmatter_fields(spark: SparkSession, root: str) -> DataFrame:
    page = compose.text_of("page_id")
    head = F.concat(
        F.lit("---\nurn: "), F.col("url"), F.lit("\n codice_redazionale : \"'C\""), page, F.lit("'\"\ndata: primo\nriga\n"),
        F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("titolo: 'Pagina: "), page, F.lit("'\n"))),
        F.lit("data: \"ultimo\"\n---\n"), F.col("html"),
    )
    docs = _wide(spark, root, "pages", "page_id", "url", "html").select(
        "page_id", F.concat(F.lit("page-"), page, F.lit(".md")).alias("file_name"), head.alias("value")
    )
    read = segment.document_fields(docs.withColumn("_e", segment.frontmatter_entries(F.col("value"))), "value",
                                   ("urn", "codice_redazionale", "data", "fonte"))
    return read.select("page_id", "urn", "codice_redazionale", "data", "fonte",
                       segment.with_default_title(F.col("_e"), F.col("file_name")).alias("titolo"))


# --- rules -------------------------------------------------------------------------------------


_SQL_LAWS = f"""
    {_SQL_LINES},
    refs AS (SELECT doc_id, list_sort(list_distinct(list(CAST(length(line) % 139 + 1 AS BIGINT)))) AS r FROM lines
        WHERE i % 2 = 0 AND NOT regexp_matches(line, '^Note\\s') GROUP BY 1),
    body AS (SELECT d.doc_id, coalesce(r, []) AS r FROM documents d LEFT JOIN refs ON refs.doc_id = d.doc_id)
"""


def _laws(spark: SparkSession, root: str) -> DataFrame:
    return _wide(spark, root, "documents", "doc_id", "lang", "source", "text").select(
        "doc_id", F.concat(F.lit("legge-"), compose.text_of("doc_id"), F.lit(".md")).alias("file_name"),
        compose.law(F.col("doc_id"), F.col("lang"), F.col("source"), F.col("text")).alias("value"),
    )


@_query("body_references", f"""
    WITH {_SQL_LAWS} SELECT doc_id, array_to_string(r, ', ') AS riferimenti FROM body
""")
def _body_references(spark: SparkSession, root: str) -> DataFrame:
    return _laws(spark, root).select("doc_id", join_numbers(rules.body_numbers(F.col("value"))).alias("riferimenti"))


@_query("revisions_table", f"""
    WITH {_SQL_LAWS},
    raw AS (SELECT d.doc_id, lang, source, doc_id % 8 AS k, r FROM documents d JOIN body USING (doc_id)),
    titled AS (SELECT *, CASE k
        WHEN 0 THEN 'Modifiche agli articoli ' || (doc_id % 90 + 9) || ', 7 e ' || (doc_id % 50 + 3) || ' della Costituzione.'
        WHEN 1 THEN 'Modifica all’articolo ' || doc_id || ' della Costituzione' WHEN 2 THEN 'REVISIONE dell''articolo ' || doc_id
        WHEN 3 THEN 'Modifiche al titolo V della parte seconda della Costituzione'
        WHEN 4 THEN 'Modifica all''articolo 1 della Costituzione e Statuto  speciale ' || lang
        WHEN 5 THEN 'Indizione di un Referendum ' || source WHEN 6 THEN 'Legge ' || source ELSE 'legge-' || doc_id END AS titolo,
        CASE k WHEN 0 THEN [doc_id % 90 + 9, 7, doc_id % 50 + 3] WHEN 1 THEN [doc_id] WHEN 2 THEN [doc_id]
            WHEN 3 THEN range(114, 134) WHEN 4 THEN [] WHEN 5 THEN [] ELSE r END AS a FROM raw)
    SELECT doc_id, 'urn:' || doc_id AS urn, '0' || doc_id AS codice_redazionale, '2001-01-01' AS data, titolo,
        array_to_string(a, ', ') AS articoli_modificati, CAST(len(a) AS BIGINT) AS n_articoli,
        CASE WHEN k = 4 THEN 'statuto_speciale' WHEN k = 5 OR len(a) = 0 THEN 'altra_legge_costituzionale'
            ELSE 'modifica_costituzione' END AS tipo
    FROM titled
""")
def _revisions_table(spark: SparkSession, root: str) -> DataFrame:
    rows = datasets.revisioni(_laws(spark, root), keep=("doc_id",))
    return rows.withColumn("articoli_modificati", join_numbers(F.col("articoli_modificati")))


_STAND_INS = {"cifre": r"[0-9]", "licenza": r"(?i)licen[sc]e", "segreto": r"(?i)token\s+=", "esclama": r"!\s*!"}


def _sql_outcome(flags: dict[str, str]) -> str:
    raised = " + ".join(f"CAST({f} AS INT)" for f in flags.values())
    cases = " ".join(f"WHEN {f} THEN '{name}'" for name, f in flags.items())
    return f"CASE WHEN {raised} > 1 THEN 'misto' {cases} ELSE 'altro' END"


@_query("flagset_verdict", f"""
    SELECT doc_id, {_sql_outcome({n: f"regexp_matches(text, '{p}')" for n, p in _STAND_INS.items()})} AS esito FROM documents
""")
def _flagset_verdict(spark: SparkSession, root: str) -> DataFrame:
    return _wide(spark, root, "documents", "doc_id", "text").select("doc_id", rules.outcome(F.col("text"), _STAND_INS).alias("esito"))


_PHRASES = {
    "illegittimo": ("o_orderstatus = 'F'", "È DICHIARATA L'ILLEGITTIMITÀ COSTITUZIONALE della norma"),
    "non_fondata": ("o_orderpriority = '1-URGENT'", "la questione è non\tfondata"),
    "inammissibile": ("o_custkey % 5 = 0", "Inammissibilità del ricorso"),
    "manifestamente_infondata": ("o_custkey % 7 = 0", "manifestamente infondata"),
}


@_query("outcome_default_rules", f"""
    SELECT o_orderkey, {_sql_outcome({name: f"({when})" for name, (when, _) in _PHRASES.items()})} AS esito FROM orders
""")
def _outcome_default_rules(spark: SparkSession, root: str) -> DataFrame:
    text = F.concat_ws(". ", F.col("o_orderpriority"), *[F.when(F.expr(w), F.lit(p)) for w, p in _PHRASES.values()])
    return _table(spark, root, "orders").select("o_orderkey", rules.outcome(text).alias("esito"))


_SPANS = {
    "punto_il": r"\.\s+[IE]n\s", "tre_parole": r"[a-z]+ue\.\s+[A-Z][a-z]+\s+[a-z]*de", "lungo": r"tion\s+tion",
}


@_query("grouped_verdict", f"""
    WITH joined AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY 1)
    SELECT conv_id, {_sql_outcome({n: f"regexp_matches(t, '{p}')" for n, p in _SPANS.items()})} AS esito FROM joined
""")
def _grouped_verdict(spark: SparkSession, root: str) -> DataFrame:
    return verdicts.group_outcome(_table(spark, root, "conversations"), "conv_id", "turn", "text", _SPANS)


_LONG_SPANS = {"sei_parole": r"[a-z]+\s+[a-z]+\.\s+[A-Z][a-z]+\s+[a-z]+\s+[a-z]+\s+[a-z]*de", "due": r"que\s+la", "cinque": r"the\s+[a-z]+\s+[a-z]+\s+[a-z]+\.\s+Th"}


@_query("grouped_verdict_long", f"""
    WITH joined AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY 1)
    SELECT conv_id, {_sql_outcome({n: f"regexp_matches(t, '{p}')" for n, p in _LONG_SPANS.items()})} AS esito FROM joined
""")
def _grouped_verdict_long(spark: SparkSession, root: str) -> DataFrame:
    """Patterns over up to six words; how many follows from the patterns."""
    return verdicts.group_outcome(_table(spark, root, "conversations"), "conv_id", "turn", "text", _LONG_SPANS)


# --- court records -----------------------------------------------------------------------------


_SQL_ACTS = """
    parts AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, unnest(range(0, o_orderkey % 2 + 1)) AS p FROM orders),
    params AS (SELECT *, unnest(range(0, c % 4)) AS j FROM parts),
    kept AS (SELECT *, (c + j) % 140 AS num FROM params WHERE j % 3 < 2 AND NOT ((c + j) % 140 % 11 = 10 AND (c + j) % 140 % 10 <> 9)),
    acts AS (SELECT k, CAST(year(d) AS BIGINT) AS anno, CASE WHEN k % 10 = 0 THEN 0 ELSE k END AS numero_atto,
        CASE WHEN p = 0 THEN 1 ELSE p END AS numero_parte, CASE WHEN num % 10 = 9 THEN 0 ELSE num END AS parametro_articolo,
        CAST(j AS VARCHAR) AS parametro_comma, CASE WHEN (k + p) % 3 = 0 THEN '' ELSE 'legge 0' END AS norma_descrizione,
        '' AS norma_numero, CASE WHEN (k + p) % 3 = 0 THEN '' ELSE '3' END AS norma_articolo,
        CASE (k + p) % 3 WHEN 0 THEN '' WHEN 1 THEN 'legge 0 art.3 c.b'
            ELSE 'legge 0 art.3 c.b; legge 1 n.' || (k + 1) || ' art.3 c.b' END AS norme_str,
        (k + p) % 3 AS n_norme FROM kept)
"""


@_query("flatten_acts", f"WITH {_SQL_ACTS} SELECT 'ordinanza' AS tipo, * EXCLUDE (k) FROM acts")
def _flatten_acts(spark: SparkSession, root: str) -> DataFrame:
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        compose.xml_of(compose.act(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")), "atto").alias("xml")
    )
    acts = flatten.flatten_acts(archives.acts_from_column(orders, "xml"), F.lit("ordinanza"))
    return schemas.select_as(acts, schemas.ATTI_PROMOVIMENTO)


# The maxims of a ruling read phrases (key + m) % 5: 0 "questione non", 1 "fondata nel merito",
# 2 "inammissibile", 3 empty, 4 other. Phrases 0 and 1 only make an outcome together.
_SQL_MAXIMS = """
    maxims AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_orderpriority AS pr,
        unnest(range(0, o_orderkey % 3 + 1)) AS m FROM orders WHERE o_orderkey % 17 <> 0),
    outcomes AS (SELECT k, CASE WHEN bool_or((k + m) % 5 = 0) AND bool_or((k + m) % 5 = 1) AND bool_or((k + m) % 5 = 2) THEN 'misto'
        WHEN bool_or((k + m) % 5 = 0) AND bool_or((k + m) % 5 = 1) THEN 'non_fondata'
        WHEN bool_or((k + m) % 5 = 2) THEN 'inammissibile' ELSE 'altro' END AS esito FROM maxims GROUP BY 1),
    padded AS (SELECT *, CASE WHEN (c + m) % 3 = 0 AND (k + m) % 3 = 0 THEN [CAST(NULL AS BIGINT)] ELSE range(0, (c + m) % 3) END AS ps,
        CASE WHEN (c + m) % 3 = 0 AND (k + m) % 3 = 0 THEN [CAST(NULL AS BIGINT)] ELSE range(0, (k + m) % 3) END AS ns FROM maxims),
    one AS (SELECT * EXCLUDE (ps), unnest(ps) AS p FROM padded),
    two AS (SELECT * EXCLUDE (ns), unnest(ns) AS n FROM one)
    SELECT k * 10 + m AS id_massima, CAST(year(d) AS BIGINT) AS anno_pronuncia, CASE WHEN k % 10 = 0 THEN 0 ELSE k END AS numero_pronuncia,
        'S' AS tipologia_pronuncia, strftime(d, '%d/%m/%Y') AS data_decisione, '' AS data_deposito, esito,
        CASE WHEN p IS NULL THEN '' ELSE 'COST' END AS parametro_codice, CASE WHEN p IS NULL THEN '' ELSE pr END AS parametro_descrizione,
        CASE WHEN p IS NULL THEN '' ELSE CAST((c + p) % 139 + 1 AS VARCHAR) END AS parametro_articolo, '' AS parametro_comma,
        CASE WHEN n IS NULL THEN '' ELSE 'L' END AS norma_codice, CASE WHEN n IS NULL THEN '' ELSE 'legge' END AS norma_descrizione,
        CASE WHEN n IS NULL THEN '' ELSE CAST(k + n AS VARCHAR) END AS norma_numero, CASE WHEN n IS NULL THEN '' ELSE ' 2001 ' END AS norma_data,
        CASE WHEN n IS NULL THEN '' ELSE CAST(n AS VARCHAR) END AS norma_articolo,
        CASE WHEN n IS NULL THEN '' ELSE 'bis' END AS norma_specificazione_articolo,
        CASE WHEN n IS NULL THEN '' ELSE '2' END AS norma_comma, '' AS norma_specificazione_comma
    FROM two JOIN outcomes USING (k)
"""


def _ruling_xml(orders: DataFrame) -> Column:
    return compose.xml_of(
        compose.ruling(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate"), F.col("o_orderpriority")), "pronuncia")


@_query("maxim_cross", f"WITH {_SQL_MAXIMS}")
def _maxim_cross(spark: SparkSession, root: str) -> DataFrame:
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    rulings = archives.rulings_from_column(orders.select(_ruling_xml(orders).alias("xml")), "xml")
    return schemas.select_as(flatten.flatten_maxims(rulings), schemas.MASSIME)


# --- archives ----------------------------------------------------------------------------------


@_query("zip_acts", f"""
    WITH {_SQL_ACTS}
    SELECT CASE WHEN k % 2 = 0 THEN 'ordinanza' ELSE 'ricorso' END AS tipo, * EXCLUDE (k) FROM acts
""")
def _zip_acts(spark: SparkSession, root: str) -> DataFrame:
    """Orders packed into register archives; only the first XML counts, and only acts below the root."""
    xml = compose.xml_of(compose.act(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")), "atto")
    rows = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        compose.text_of("o_orderkey").alias("folder"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("ordinanze.zip")).otherwise(F.lit("ricorsi.zip")).alias("archive"),
        xml.alias("xml"),
    )
    packed = compose.pack(rows, compose.packers()[0])
    kinds = {"ordinanze.zip": "ordinanza", "ricorsi.zip": "ricorso"}
    return schemas.select_as(datasets.atti_promovimento(packed, kinds), schemas.ATTI_PROMOVIMENTO)


@_query("zip_maxims", f"WITH {_SQL_MAXIMS}")
def _zip_maxims(spark: SparkSession, root: str) -> DataFrame:
    """Orders packed into archives of archives; the malformed member gives no rows."""
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    rows = orders.select(
        compose.text_of("o_orderkey").alias("folder"), F.lit("massime.zip").alias("archive"), _ruling_xml(orders).alias("xml")
    )
    return schemas.select_as(datasets.massime(compose.pack(rows, compose.packers()[1])), schemas.MASSIME)


def _landed(packed: DataFrame, name: str) -> str:
    """Archives (``archive, content``) as files of a folder, under the names of their paths."""
    out = shared_dir(packed.sparkSession, name)
    flat = packed.select(F.replace("archive", F.lit("/"), F.lit("-")).alias("name"), "content")
    published.publish_documents(flat, out, "name", "content")
    return published.current(packed.sparkSession, out)


@_query("zip_acts_by_range", f"""
    WITH {_SQL_ACTS}
    SELECT CASE WHEN k % 2 = 0 THEN 'ordinanza' ELSE 'ricorso' END AS tipo, * EXCLUDE (k) FROM acts
""")
def _zip_acts_by_range(spark: SparkSession, root: str) -> DataFrame:
    """The archives of ``zip_acts`` as files, read by ranges of their directories."""
    xml = compose.xml_of(compose.act(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")), "atto")
    rows = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        compose.text_of("o_orderkey").alias("folder"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("ordinanze.zip")).otherwise(F.lit("ricorsi.zip")).alias("archive"), xml.alias("xml"))
    folder = _landed(compose.pack(rows, compose.packers()[0]), "atti")
    kind = F.when(F.col("archive").endswith("-ordinanze.zip"), "ordinanza").otherwise("ricorso")
    return schemas.select_as(flatten.flatten_acts(archives.acts_by_range(spark, folder), kind), schemas.ATTI_PROMOVIMENTO)


@_query("zip_maxims_by_range", f"WITH {_SQL_MAXIMS}")
def _zip_maxims_by_range(spark: SparkSession, root: str) -> DataFrame:
    """The archives of ``zip_maxims`` as files, read by ranges of their directories."""
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    rows = orders.select(compose.text_of("o_orderkey").alias("folder"), F.lit("massime.zip").alias("archive"), _ruling_xml(orders).alias("xml"))
    folder = _landed(compose.pack(rows, compose.packers()[1]), "massime")
    return schemas.select_as(flatten.flatten_maxims(archives.rulings_by_range(spark, folder)), schemas.MASSIME)


@_query("xml_files", f"WITH {_SQL_MAXIMS}")
def _xml_files(spark: SparkSession, root: str) -> DataFrame:
    """Rulings written to XML files, which are cut into records by many tasks."""
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = shared_dir(spark, "xml")
    # Written in blocks of a fast codec, a fraction of the bytes. Such a file is read by one task, so none has more records than make up a split.
    orders.select(_ruling_xml(orders).alias("value")).write.option("maxRecordsPerFile", 100_000).text(out, compression="snappy")
    return schemas.select_as(flatten.flatten_maxims(archives.rulings_from_files(spark, out)), schemas.MASSIME)


# --- publication and contracts -----------------------------------------------------------------
@_query("csv_parquet_roundtrip", """
    SELECT doc_id AS articolo, '' AS disposizione, lang AS parte, source AS titolo, text AS testo, n_chars AS commi,
        doc_id AS articolo_parquet, text AS testo_parquet FROM documents
""")
def _csv_parquet_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "documents").select(
        F.col("doc_id").alias("articolo"), F.lit(None).cast("string").alias("disposizione"), F.col("lang").alias("parte"),
        F.col("source").alias("titolo"), F.lit("").alias("sezione"), F.lit("").alias("heading"),
        F.col("text").alias("testo"), F.col("n_chars").alias("commi"),
    )
    out = shared_dir(spark, "articoli")
    tables.publish(rows, out, schemas.ARTICOLI)
    csv = tables.read_csv(spark, f"{out}/csv", schemas.ARTICOLI)
    typed = spark.read.schema(schemas.ARTICOLI).parquet(f"{out}/parquet").select(
        "articolo", F.col("articolo").alias("articolo_parquet"), F.col("testo").alias("testo_parquet")
    )
    return csv.drop("sezione", "heading").join(typed, "articolo")


@_query("documents_roundtrip", r"""
    SELECT 'leggi-' || s_suppkey AS documento, '---' || chr(10) || 'tipo: PROVA' || chr(10) || '---' || chr(10) || chr(10)
        || '# ' || s_name || chr(10) || chr(10) || '## Titolo Voce' || chr(10) || '### Sezione ' || s_nationkey || chr(10)
        || '## Art. ' || s_suppkey || chr(10) || 'testo in riga' || chr(10) || 'e' || chr(10) || 'a capo fine' || chr(10) || chr(10)
        || '*corsivo* e **grassetto**' || chr(10) || '### I' || chr(10) || '# ' || s_name || chr(10) AS contenuto
    FROM supplier
""")
def _documents_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Wikitext to Markdown files, one per supplier, and back."""
    section = F.concat(F.lit("Sezione "), compose.text_of("s_nationkey"))
    pages = _wide(spark, root, "supplier", "s_suppkey", "s_name", "s_nationkey").select(
        F.concat(F.lit("leggi-"), compose.text_of("s_suppkey")).alias("file_name"),
        compose.wikitext(F.col("s_name"), section, compose.text_of("s_suppkey")).alias("value"),
    )
    out = shared_dir(spark, "testo")
    documents.write_documents(datasets.testo(pages, frontmatter="---\ntipo: PROVA\n---\n"), out)
    return documents.read_written_documents(spark, out)


@_query("published_sql", """
    SELECT CAST(user_id % 25 AS BIGINT) AS articolo, count(*) AS n, count(DISTINCT event_id) AS fonti FROM events GROUP BY 1 HAVING count(*) > 1
""")
def _published_sql(spark: SparkSession, root: str) -> DataFrame:
    """Publish a table, register the published tables as views, and ask them in SQL."""
    rows = _table(spark, root, "events").select(
        compose.text_of("event_id").alias("fonte_filename"), F.col("event_type").alias("fonte_collezione"), F.lit(2000).cast("bigint").alias("fonte_anno"),
        F.lit("legge").alias("fonte_tipo"), (F.col("user_id") % 25).cast("bigint").alias("articolo"), F.lit("").alias("contesto"), F.lit("").alias("articolo_testo"),
    )
    out = shared_dir(spark, "pubblicati")
    tables.publish(rows, f"{out}/citazioni_legislative", schemas.CITAZIONI)
    datasets.register_views(spark, out)
    return spark.sql("""
        SELECT articolo, count(*) AS n, count(DISTINCT fonte_filename) AS fonti FROM citazioni_legislative GROUP BY articolo HAVING count(*) > 1""")


@_query("published_invocations", f"""
    WITH {_SQL_ACTS}
    SELECT parametro_articolo, count(*) AS volte FROM acts GROUP BY parametro_articolo
""")
def _published_invocations(spark: SparkSession, root: str) -> DataFrame:
    """Acts published as a version whose contract holds, then the published statement for the most invoked article."""
    orders = _wide(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    xml = compose.xml_of(compose.act(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")), "atto")
    acts = flatten.flatten_acts(archives.acts_from_column(orders.select(xml.alias("xml")), "xml"), F.lit("ordinanza"))
    out = shared_dir(spark, "pubblicati")
    published.publish(acts, f"{out}/atti_promovimento", schemas.ATTI_PROMOVIMENTO, rules=[quality.rows_at_least(1)])
    datasets.register_views(spark, out)
    return spark.sql("""
        SELECT parametro_articolo, COUNT(*) AS volte FROM atti_promovimento GROUP BY parametro_articolo ORDER BY volte DESC""")


@_query("published_acceptance", """
    SELECT CAST(l_suppkey % 140 AS VARCHAR) AS parametro_articolo, round(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS pct
    FROM lineitem GROUP BY 1 HAVING count(*) > 50
""")
def _published_acceptance(spark: SparkSession, root: str) -> DataFrame:
    """Maxims published as a version, then the published statement for the rate of acceptance."""
    flag = F.col("l_returnflag")
    outcome = F.when(flag == "A", "illegittimo").when(flag == "R", "non_fondata").otherwise("inammissibile")
    blank = [F.lit("").alias(f.name) for f in schemas.MASSIME if f.name not in ("id_massima", "anno_pronuncia", "numero_pronuncia", "esito", "parametro_articolo")]
    maxims = _table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("id_massima"), F.year("l_shipdate").alias("anno_pronuncia"), F.col("l_linenumber").alias("numero_pronuncia"),
        outcome.alias("esito"), compose.text_of(F.col("l_suppkey") % 140).alias("parametro_articolo"), *blank)
    out = shared_dir(spark, "pubblicati")
    published.publish(maxims, f"{out}/massime", schemas.MASSIME, rules=[quality.rows_at_least(1)])
    datasets.register_views(spark, out)
    rates = spark.sql("""
        SELECT parametro_articolo, SUM(CASE WHEN esito = 'illegittimo' THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS pct
        FROM massime GROUP BY parametro_articolo HAVING COUNT(*) > 50 ORDER BY pct DESC""")
    return rates.select("parametro_articolo", F.round(F.col("pct").cast("double"), 4).alias("pct"))


@_query("published_report", """
    SELECT 'rows' AS rule, count(*) > 0 AS ok, count(*) AS observed FROM events
    UNION ALL SELECT 'articolo not null', count(*) = count(*), count(*) FROM events
    UNION ALL SELECT 'fonte_collezione free of ^$', count(*) FILTER (event_type = '') = 0, count(*) FILTER (event_type = '') FROM events
    UNION ALL SELECT 'current', true, count(*) FROM events
""")
def _published_report(spark: SparkSession, root: str) -> DataFrame:
    """The contract of a table, measured while it is written; a later, empty table is left out and changes nothing."""
    events = _table(spark, root, "events")
    rows = events.select(
        compose.text_of("event_id").alias("fonte_filename"), F.col("event_type").alias("fonte_collezione"), F.lit(2000).cast("bigint").alias("fonte_anno"),
        F.lit("legge").alias("fonte_tipo"), F.col("user_id").alias("articolo"), F.lit("").alias("contesto"), F.lit("").alias("articolo_testo"))
    out = shared_dir(spark, "pubblicati")
    known = quality.Rule("articolo not null", F.count("articolo"), 1)
    report = published.publish(rows, out, schemas.CITAZIONI, rules=[quality.rows_at_least(1), known, quality.no_match("fonte_collezione", "^$")])
    published.publish(rows.where("articolo < 0"), out, schemas.CITAZIONI, when_empty="skip")
    kept = published.read_table(spark, out, schemas.CITAZIONI).agg(F.count("*").alias("observed"))
    return report.unionByName(kept.select(F.lit("current").alias("rule"), F.lit(True).alias("ok"), "observed"))


@_query("ordered_indicators", """
    SELECT CAST(p_size AS BIGINT) AS articolo, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS posizione, p_name AS dataset_slug, p_brand AS dimensione FROM part
""")
def _ordered_indicators(spark: SparkSession, root: str) -> DataFrame:
    """Entries under their articles, published in the order of articles and, within one, of the mapping."""
    entries = tables.clean_mapping(_table(spark, root, "part").select(
        F.col("p_partkey").alias("ordinal"), F.col("p_size").cast("bigint").alias("articolo"), F.col("p_name").alias("dataset_slug"),
        F.col("p_brand").alias("dimensione"), F.lit(None).cast("string").alias("tipo")))
    none = spark.createDataFrame([], "dataset_slug string, has_name boolean, name string, has_source boolean, source string")
    rows = datasets.indicatori_costituzionali(entries, none)
    out = shared_dir(spark, "indicatori")
    published.publish(rows.orderBy("articolo", "ordinal"), out, schemas.INDICATORI)
    # The order in which the rows lie in the files, the first file first, is that of the mapping.
    place = F.struct("_metadata.file_name", "_metadata.row_index")
    lying = spark.read.schema(schemas.INDICATORI).parquet(f"{published.current(spark, out)}/parquet").select("articolo", "dataset_slug", "dimensione", place.alias("_place"))
    return lying.select("articolo", F.row_number().over(Window.partitionBy("articolo").orderBy("_place")).cast("bigint").alias("posizione"), "dataset_slug", "dimensione")


def _supplier_pages(spark: SparkSession, root: str) -> str:
    """A folder with a Markdown document for each supplier, under the supplier's name."""
    docs = _table(spark, root, "supplier").select(
        F.concat("s_name", F.lit(".md")).alias("documento"),
        F.concat(F.lit("# "), F.col("s_name"), F.lit("\r\nchiave: "), compose.text_of("s_suppkey"), F.lit("\r\n")).alias("contenuto"))
    out = shared_dir(spark, "documenti")
    published.publish_documents(docs, out)
    return published.current(spark, out)


@_query("named_documents", """
    SELECT s_name || '.md' AS file_name, '# ' || s_name || chr(10) || 'chiave: ' || s_suppkey || chr(10) AS value FROM supplier
""")
def _named_documents(spark: SparkSession, root: str) -> DataFrame:
    """A file for each document, under the document's name, read as whole documents."""
    return documents.read_documents(spark, _supplier_pages(spark, root))


@_query("single_document", """
    SELECT s_name || '.md' AS file_name, '# ' || s_name || chr(10) || 'chiave: ' || s_suppkey || chr(10) AS value FROM supplier
    WHERE s_name = (SELECT max(s_name) FROM supplier)
""")
def _single_document(spark: SparkSession, root: str) -> DataFrame:
    """One of many landed documents, by its path."""
    folder = _supplier_pages(spark, root)
    name = _table(spark, root, "supplier").agg(F.max("s_name")).first()[0]
    return documents.read_document(spark, f"{folder}/{name}.md")


@_query("documents_from_files", """
    SELECT '# ' || n_name || chr(10) || 'tipo: ' || n_regionkey || chr(10) AS value FROM nation
""")
def _documents_from_files(spark: SparkSession, root: str) -> DataFrame:
    """One text file per nation in a flat folder, read as whole documents."""
    texts = _table(spark, root, "nation").select(
        F.concat(F.lit("# "), F.col("n_name"), F.lit("\r\ntipo: "), compose.text_of("n_regionkey"), F.lit("\r\n")).alias("contenuto"))
    out = shared_dir(spark, "file")
    documents.write_text(texts, out)
    return documents.read_documents(spark, out, "*.txt").select("value")


@_query("member_years", """
    SELECT CASE WHEN o_orderkey % 11 = 0 THEN '??' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS anno, count(*) AS n FROM orders GROUP BY 1
""")
def _member_years(spark: SparkSession, root: str) -> DataFrame:
    """Years in the names of archive members."""
    year = F.when(F.col("o_orderkey") % 11 == 0, "senza").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    members = _table(spark, root, "orders").select(archives.member_year(F.concat(F.lit("m_"), year, F.lit(".xml"))).alias("anno"))
    return metrics.count_by(members, "anno", "n")


@_query("array_csv_roundtrip", """
    SELECT doc_id AS urn, array_to_string([try_cast(n AS BIGINT) FOR n IN regexp_extract_all(text, '[0-9]+')], ', ') AS articoli_modificati
    FROM documents
""")
def _array_csv_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "documents").select(
        F.col("doc_id").alias("urn"), numbers_in(F.col("text")).alias("articoli_modificati")
    )
    out = shared_dir(spark, "numeri")
    tables.write_csv(rows, out)
    return tables.read_csv(spark, out, schemas.struct(schemas.long("urn"), "articoli_modificati"))


@_query("dq_report", r"""
    WITH m AS (SELECT count(*) AS n, count(doc_id) AS keys, count(*) FILTER (doc_id = 3) AS three,
        count(*) FILTER (lang NOT IN ('en', 'fr')) AS foreign_, count(*) FILTER (n_chars > 500) AS long_,
        count(*) FILTER (regexp_matches(text, '<ref>|<br')) AS markup, count(*) FILTER (coalesce(text, '') IN ('', '0')) AS blank,
        count(*) FILTER (list_contains([try_cast(x AS BIGINT) FOR x IN regexp_extract_all(text, '[0-9]+')], 9)) AS nines,
        CAST(sum(len(regexp_extract_all(text, 'tion'))) AS BIGINT) AS marks, count(*) FILTER (n_chars <> length(text)) AS wrong FROM documents)
    SELECT 'rows' AS rule, n >= 200 AS ok, n AS observed FROM m
    UNION ALL SELECT 'doc_id not null', keys = 1000, keys FROM m
    UNION ALL SELECT 'doc_id has 3', three >= 1, three FROM m
    UNION ALL SELECT 'lang in domain', foreign_ = 0, foreign_ FROM m
    UNION ALL SELECT 'long texts', long_ >= 15, long_ FROM m
    UNION ALL SELECT 'text free of <ref>|<br', markup = 0, markup FROM m
    UNION ALL SELECT 'text not empty', blank = 0, blank FROM m
    UNION ALL SELECT 'numbers has 9', nines >= 1, nines FROM m
    UNION ALL SELECT 'text markers tion', marks >= 1, marks FROM m
    UNION ALL SELECT 'n_chars matches', wrong = 0, wrong FROM m
    UNION ALL SELECT 'schema_version is 1', foreign_ = 0, foreign_ FROM m
    UNION ALL SELECT 'doc_id references', count(*) = 0, count(*) FROM
        (SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    UNION ALL SELECT 'column text', true, 1
    UNION ALL SELECT 'type text string', true, 1
    UNION ALL SELECT 'column testo', false, 0
""")
def _dq_report(spark: SparkSession, root: str) -> DataFrame:
    docs = _wide(spark, root, "documents", "doc_id", "lang", "n_chars", "text")
    with_numbers = docs.withColumn("numbers", numbers_in(F.col("text"))).withColumn("schema_version", F.when(F.col("lang").isin("en", "fr"), 1).otherwise(2))
    report = quality.dq_report(with_numbers, [
        quality.rows_at_least(200),
        quality.not_null_exactly("doc_id", 1000),
        quality.has_value("doc_id", 3),
        quality.only_values("lang", ["en", "fr"]),
        quality.at_least_where("long texts", F.col("n_chars") > 500, 15),
        quality.no_match("text", "<ref>|<br"),
        quality.not_empty("text"),
        quality.array_has("numbers", 9),
        quality.marker_count("text", "tion", 1),
        quality.always("n_chars matches", F.col("n_chars") == F.char_length("text")),
        quality.version_is("schema_version", 1, with_numbers.columns),
    ])
    return (
        report
        .unionByName(quality.reference_report(docs, _table(spark, root, "labels"), "doc_id"))
        .unionByName(quality.schema_report(docs, {"text": "string", "testo": None}))
    )
