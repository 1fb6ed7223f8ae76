"""Nested court records to flat rows. Map-only: the explodes need no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexspark import fixed
from lexspark.functions.arrays import each
from lexspark.functions.rules import outcome
from lexspark.functions.text import digits_or, int_or_zero, or_empty, strip

MAXIM_FIELDS = ("codice", "descrizione", "articolo", "comma")
NORM_FIELDS = (
    "codice", "descrizione", "numero", "data", "articolo",
    "specificazione_articolo", "comma", "specificazione_comma",
)


def _clean(record: Column, field: str) -> Column:
    return strip(or_empty(record[field]))


def _norm_text(norm: Column) -> Column:
    """``descr n.num art.art c.comma``; the number part only when there is a number."""
    number = _clean(norm, "numero")
    return F.concat(
        _clean(norm, "descrizione"),
        F.when(number != "", F.concat(F.lit(" n."), number)).otherwise(F.lit("")),
        F.lit(" art."), _clean(norm, "articolo"), F.lit(" c."), _clean(norm, "comma"),
    )


def flatten_acts(df: DataFrame, kind: Column, record: str = "record", keep: tuple[str, ...] = (),
                 parameter: str = fixed.CONSTITUTION_PARAMETER) -> DataFrame:
    """One row per (act, part, constitutional parameter).

    ``record`` has the shape of ``schemas.ACT``. Act fields are made before the parts are
    exploded and part fields before the parameters are, so nothing is computed per output row
    that belongs to a parent; parameters are filtered inside their array.
    """
    act, part, param = F.col(record), F.col("_part"), F.col("_par")
    header = [*keep, "tipo", "anno", "numero_atto"]
    acts = df.select(
        *keep, kind.alias("tipo"),
        digits_or(or_empty(act["anno"]), 0).alias("anno"),
        digits_or(or_empty(act["numero"]), 0).alias("numero_atto"),
        act["parti"].alias("_parts"),
    )
    norms = F.coalesce(part["norme"], F.array())
    first = F.get(norms, F.lit(0))
    wanted = F.filter(
        part["parametri"],
        lambda p: (F.lower(_clean(p, "descrizione")) == parameter) & (_clean(p, "articolo") != ""),
    )
    parts = acts.select(*header, each(F.col("_parts")).alias("_part")).select(
        *header,
        digits_or(_clean(part, "numero_parte"), 1).alias("numero_parte"),
        _clean(first, "descrizione").alias("norma_descrizione"),
        _clean(first, "numero").alias("norma_numero"),
        _clean(first, "articolo").alias("norma_articolo"),
        F.array_join(F.transform(norms, _norm_text), "; ").alias("norme_str"),
        F.size(norms).cast("bigint").alias("n_norme"),
        wanted.alias("_wanted"),
    )
    fields = ["norma_descrizione", "norma_numero", "norma_articolo", "norme_str", "n_norme"]
    return parts.select(*header, "numero_parte", *fields, each(F.col("_wanted")).alias("_par")).select(
        *header, "numero_parte",
        digits_or(_clean(param, "articolo"), 0).alias("parametro_articolo"),
        _clean(param, "comma").alias("parametro_comma"),
        *fields,
    )


def ruling_text(maxims: Column) -> Column:
    """The non-empty texts of a ruling's maxims, in document order."""
    return F.array_join(F.filter(F.transform(maxims, lambda m: m["testo"]), lambda t: t != ""), " ")


def _blank(fields: tuple[str, ...], like: T.DataType) -> Column:
    return F.array(F.struct(*[F.lit("").alias(f) for f in fields])).cast(like)


def flatten_maxims(df: DataFrame, record: str = "record", keep: tuple[str, ...] = (),
                   patterns: dict[str, str] = fixed.OUTCOME_PATTERNS) -> DataFrame:
    """One row per (maxim, parameter, norm), with the outcome of the whole ruling.

    ``record`` has the shape of ``schemas.RULING``. The outcome is made once per ruling, before
    its maxims are exploded, and their texts go no further. A maxim with neither parameters nor
    norms gives one blank row, one with only one of the two gives none, so each side is padded
    only when both are empty and the two explodes do the rest.
    """
    ruling, maxim = F.col(record), F.col("_m")
    head = ruling["testata"]
    shape = df.schema[record].dataType["massime"].dataType.elementType
    bare = F.transform(
        ruling["massime"],
        lambda m: F.struct(m["numero"].alias("numero"), m["parametri"].alias("parametri"), m["norme"].alias("norme")),
    )
    head_fields = ["anno_pronuncia", "numero_pronuncia", "tipologia_pronuncia", "data_decisione", "data_deposito"]
    rulings = df.select(
        *keep,
        *[digits_or(or_empty(head[f]), 0).alias(f) for f in head_fields[:2]],
        *[or_empty(head[f]).alias(f) for f in head_fields[2:]],
        ruling_text(ruling["massime"]).alias("_text"),
        F.when(head.isNotNull(), bare).alias("_maxims"),
    )
    header = [*keep, *head_fields, "esito"]
    maxims = rulings.select(
        *keep, *head_fields, outcome(F.col("_text"), patterns).alias("esito"), "_maxims"
    ).select(*header, each(F.col("_maxims")).alias("_m"))
    empty = (F.coalesce(F.size(maxim["parametri"]), F.lit(0)) <= 0) & (F.coalesce(F.size(maxim["norme"]), F.lit(0)) <= 0)
    sides = maxims.select(
        *header, int_or_zero(or_empty(maxim["numero"])).alias("id_massima"),
        F.when(empty, _blank(MAXIM_FIELDS, shape["parametri"].dataType)).otherwise(maxim["parametri"]).alias("_params"),
        F.when(empty, _blank(NORM_FIELDS, shape["norme"].dataType)).otherwise(maxim["norme"]).alias("_norms"),
    )
    header.append("id_massima")
    crossed = sides.select(*header, "_norms", each(F.col("_params")).alias("_par")).select(
        *header, "_par", each(F.col("_norms")).alias("_norm")
    )
    return crossed.select(
        *keep, "id_massima", *head_fields, "esito",
        *[or_empty(F.col("_par")[f]).alias(f"parametro_{f}") for f in MAXIM_FIELDS],
        *[or_empty(F.col("_norm")[f]).alias(f"norma_{f}") for f in NORM_FIELDS],
    )
