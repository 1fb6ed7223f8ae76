"""Contract of each published dataset as a report of ``(rule, ok, observed)``.

Row and key counts are those of the published corpus; every function takes them as parameters for
other corpora. A contract can be checked on a table, or while the table is published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark import fixed, schemas
from lexspark.operators import quality


@dataclass(frozen=True)
class Contract:
    """Columns a dataset has to have, with types where they matter, and rules its rows have to keep."""

    columns: dict[str, str | None]
    rules: list[quality.Rule]

    def report(self, df: DataFrame) -> DataFrame:
        measured = quality.dq_report(df, self.rules)
        return quality.schema_report(df, self.columns).unionByName(measured) if self.columns else measured


def _columns(schema) -> dict[str, str | None]:
    return {f.name: f.dataType.simpleString() for f in schema}


def testo_contract(articles: int = 139, provisions: int = 18, text: str = "value",
                   frontmatter: tuple[str, ...] = ("tipo: COSTITUZIONE", "urn: urn:nir:stato:costituzione:1947-12-27",
                                                   "codice_redazionale: 047U0001", "vigente: true")) -> Contract:
    final = F.substring_index(F.col(text), fixed.FINAL_PART, -1)
    return Contract({}, [
        *[quality.always(line, F.col(text).contains(line)) for line in frontmatter],
        quality.marker_count(text, r"## Art\.", articles, articles),
        quality.Rule("provisions", F.sum(F.regexp_count(final, F.lit("(?md)^### ")).cast("bigint")), provisions),
        quality.no_match(text, "<ref>|<br"),
    ])


def articoli_contract(rows: int = 157, articles: int = 139, required: int = 32) -> Contract:
    return Contract(_columns(schemas.ARTICOLI), [
        quality.rows_exactly(rows), quality.not_null_exactly("articolo", articles), quality.has_value("articolo", required),
    ])


def revisioni_contract(rows: int = 50, amendments: int = 15, required: int = 9) -> Contract:
    return Contract(_columns(schemas.REVISIONI), [
        quality.rows_exactly(rows),
        quality.at_least_where("amendments", F.col("tipo") == fixed.AMENDMENT, amendments),
        quality.array_has("articoli_modificati", required),
    ])


def atti_promovimento_contract(rows: int = 900, required: int = 3) -> Contract:
    return Contract(_columns(schemas.ATTI_PROMOVIMENTO), [
        quality.rows_at_least(rows), quality.has_value("parametro_articolo", required),
        *[quality.has_value("tipo", kind) for kind in fixed.ARCHIVE_KINDS.values()],
    ])


def massime_contract(rows: int = 1) -> Contract:
    return Contract({"esito": None, "parametro_articolo": None, "norma_numero": None}, [quality.rows_at_least(rows)])


def citazioni_legislative_contract(rows: int = 1) -> Contract:
    return Contract(dict.fromkeys(("articolo", "fonte_filename", "contesto", "articolo_testo")), [quality.rows_at_least(rows)])


def indicatori_costituzionali_contract(rows: int = 30, required: tuple[int, ...] = (9, 32)) -> Contract:
    return Contract(_columns(schemas.INDICATORI), [
        quality.rows_at_least(rows), *[quality.has_value("articolo", article) for article in required],
    ])


def testo(markdown: DataFrame, *args, **kwargs) -> DataFrame:
    return testo_contract(*args, **kwargs).report(markdown)


def articoli(df: DataFrame, *args, **kwargs) -> DataFrame:
    return articoli_contract(*args, **kwargs).report(df)


def revisioni(df: DataFrame, *args, **kwargs) -> DataFrame:
    return revisioni_contract(*args, **kwargs).report(df)


def atti_promovimento(df: DataFrame, *args, **kwargs) -> DataFrame:
    return atti_promovimento_contract(*args, **kwargs).report(df)


def massime(df: DataFrame, *args, **kwargs) -> DataFrame:
    return massime_contract(*args, **kwargs).report(df)


def citazioni_legislative(df: DataFrame, *args, **kwargs) -> DataFrame:
    return citazioni_legislative_contract(*args, **kwargs).report(df)


def indicatori_costituzionali(df: DataFrame, *args, **kwargs) -> DataFrame:
    return indicatori_costituzionali_contract(*args, **kwargs).report(df)


def mapping(entries: DataFrame, registry: DataFrame, version: int = fixed.MAPPING_VERSION) -> DataFrame:
    """Curated mapping: its version, filled fields, known kinds, slugs that exist in the registry."""
    rules = [quality.version_is("schema_version", version, entries.columns), quality.rows_at_least(1), *[quality.not_empty(c) for c in ("articolo", "dataset_slug", "dimensione")],
             quality.only_values("tipo", fixed.INDICATOR_KINDS)]
    return quality.dq_report(entries, rules).unionByName(quality.reference_report(entries, registry, "dataset_slug"))
