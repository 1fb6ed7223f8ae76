"""Questions over the published tables. ``articolo`` is the hub they all join on.

``massime.parametro_articolo`` is text; it takes part as a number where it is one. The value 0
stands for "no number" in ``atti_promovimento`` and is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.arrays import each
from lexspark.functions.text import digits_or
from lexspark.operators import enrich, metrics


def article_numbers(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("articolo").isNotNull()).select("articolo")


def acts_by_article(acts: DataFrame) -> DataFrame:
    return acts.where("parametro_articolo <> 0").select(F.col("parametro_articolo").alias("articolo"))


def maxims_by_article(maxims: DataFrame) -> DataFrame:
    number = digits_or(F.col("parametro_articolo"), None)
    return maxims.select(number.alias("articolo"), "esito").where(F.col("articolo").isNotNull())


def amendments_by_article(revisions: DataFrame) -> DataFrame:
    return revisions.select(each("articoli_modificati").alias("articolo"))


def most_invoked(acts: DataFrame) -> DataFrame:
    return metrics.ranked(metrics.count_by(acts, "parametro_articolo"), "parametro_articolo")


def most_amended(revisions: DataFrame) -> DataFrame:
    return metrics.ranked(metrics.element_counts(revisions, "articoli_modificati", "articolo"), "articolo")


def most_accepted(maxims: DataFrame) -> DataFrame:
    accepted = maxims.where(F.col("esito") == fixed.ACCEPTED_OUTCOME)
    return metrics.ranked(metrics.count_by(accepted, "parametro_articolo"), "parametro_articolo")


def outcomes(maxims: DataFrame) -> DataFrame:
    """Accepted, rejected and all rulings rows of every article."""
    return metrics.conditional_counts(maxims, {
        "accolte": F.col("esito") == fixed.ACCEPTED_OUTCOME,
        "respinte": F.col("esito") == fixed.REJECTED_OUTCOME,
        "totale": F.lit(True),
    }, ("parametro_articolo",))


def outcomes_of(maxims: DataFrame, article: int) -> DataFrame:
    return metrics.count_by(maxims.where(F.col("parametro_articolo") == str(article)), "esito")


def citations_per_article(citations: DataFrame) -> DataFrame:
    return metrics.ranked(metrics.count_by(citations.where("articolo is not null"), "articolo"), "articolo")


def laws_citing(citations: DataFrame, article: int) -> DataFrame:
    return citations.where(F.col("articolo") == article).select(
        "fonte_filename", "fonte_collezione", "fonte_anno", "fonte_tipo"
    ).distinct()


def datasets_for(indicators: DataFrame, article: int) -> DataFrame:
    return indicators.where(F.col("articolo") == article).select("dataset_slug", "dataset_name", "dimensione").distinct()


def cited_never_litigated(citations: DataFrame, acts: DataFrame, maxims: DataFrame) -> DataFrame:
    litigated = acts_by_article(acts).unionByName(maxims_by_article(maxims).select("articolo"))
    return enrich.missing_keys(citations, litigated, "articolo")


def without_implementing_law(articles: DataFrame, citations: DataFrame) -> DataFrame:
    """Proxy for "not implemented": no ordinary law cites the article."""
    return enrich.missing_keys(article_numbers(articles), citations, "articolo")


def article_scorecard(articles: DataFrame, acts: DataFrame, maxims: DataFrame, citations: DataFrame,
                      revisions: DataFrame, indicators: DataFrame) -> DataFrame:
    every = F.lit(True)
    counted = metrics.scorecard(article_numbers(articles), "articolo", [
        (acts_by_article(acts), {"invocazioni": every}),
        (maxims_by_article(maxims), {"massime": every, "accolte": F.col("esito") == fixed.ACCEPTED_OUTCOME}),
        (citations, {"citazioni": every}),
        (amendments_by_article(revisions), {"revisioni": every}),
        (indicators, {"indicatori": every}),
    ])
    return counted.withColumn("pct_accolte", F.try_divide(F.col("accolte") * F.lit(100.0), F.col("massime")))
