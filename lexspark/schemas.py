"""Target schemas of the seven datasets and the projection applied before every write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct(*fields: str | tuple[str, T.DataType]) -> T.StructType:
    """Fields in order; a bare name is a string."""
    return T.StructType([
        T.StructField(f, T.StringType()) if isinstance(f, str) else T.StructField(*f) for f in fields
    ])


def long(name: str) -> tuple[str, T.DataType]:
    return name, T.LongType()


TESTO = struct("documento", "contenuto")

ARTICOLI = struct(
    long("articolo"), "disposizione", "parte", "titolo", "sezione", "heading", "testo", long("commi")
)

REVISIONI = struct(
    "urn", "codice_redazionale", "data", "titolo",
    ("articoli_modificati", T.ArrayType(T.LongType())), long("n_articoli"), "tipo",
)

ATTI_PROMOVIMENTO = struct(
    "tipo", long("anno"), long("numero_atto"), long("numero_parte"), long("parametro_articolo"),
    "parametro_comma", "norma_descrizione", "norma_numero", "norma_articolo", "norme_str", long("n_norme"),
)

MASSIME = struct(
    long("id_massima"), long("anno_pronuncia"), long("numero_pronuncia"), "tipologia_pronuncia",
    "data_decisione", "data_deposito", "esito",
    "parametro_codice", "parametro_descrizione", "parametro_articolo", "parametro_comma",
    "norma_codice", "norma_descrizione", "norma_numero", "norma_data", "norma_articolo",
    "norma_specificazione_articolo", "norma_comma", "norma_specificazione_comma",
)

CITAZIONI = struct(
    "fonte_filename", "fonte_collezione", long("fonte_anno"), "fonte_tipo", long("articolo"),
    "contesto", "articolo_testo",
)

INDICATORI = struct(
    long("articolo"), "dataset_slug", "dataset_name", "fonte", "dimensione", "tipo_indicatore"
)

# --- XML records, as delivered by lexspark.sources.archives ------------------------------------
ACT_NORM = struct("descrizione", "numero", "data", "articolo", "comma", "nesso")
ACT_PARAMETER = struct("descrizione", "articolo", "comma")
ACT = struct("anno", "numero", ("parti", T.ArrayType(struct(
    "numero_parte", ("norme", T.ArrayType(ACT_NORM)), ("parametri", T.ArrayType(ACT_PARAMETER)),
))))

RULING_HEAD = struct(
    "anno_pronuncia", "numero_pronuncia", "tipologia_pronuncia", "data_decisione", "data_deposito"
)
MAXIM_PARAMETER = struct("codice", "descrizione", "articolo", "comma")
MAXIM_NORM = struct(
    "codice", "descrizione", "numero", "data", "articolo",
    "specificazione_articolo", "comma", "specificazione_comma",
)
RULING = struct(("testata", RULING_HEAD), ("massime", T.ArrayType(struct(
    "numero", "testo", ("parametri", T.ArrayType(MAXIM_PARAMETER)), ("norme", T.ArrayType(MAXIM_NORM)),
))))


def select_as(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the columns, order and types of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
