"""Wikitext to Markdown as one chain of expressions over a text column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexspark import fixed
from lexspark.functions.text import replace_all, strip


def crop(text: Column, formula: str = fixed.PROMULGATION, fallback: str = fixed.TOC_END) -> Column:
    """The text after the opening formula, else after the contents table, else all of it."""
    opening = re.escape(formula).replace(r"\ ", " ") + r"\s*\n"
    after_table = F.instr(text, fallback)
    return strip(
        F.when(text.rlike(f"(?U){opening}"), F.regexp_extract(text, rf"(?sU){opening}(.*)\z", 1))
        .when(after_table > 1, F.substring(text, after_table + len(fallback), F.char_length(text)))
        .otherwise(text)
    )


def clean(text: Column) -> Column:
    """Templates, tables, links, line breaks, notes, tags and runs of spaces."""
    return F.ltrim(replace_all(text, fixed.MARKUP_RULES), F.lit("\n"))


def headings(text: Column) -> Column:
    """Trim every line and rewrite ``=`` headings to ``#`` headings.

    The rules run over the whole text with line anchors. A rewritten line starts with ``#``, which
    no later rule accepts, so the first fitting rule is the only one that acts on a line.
    """
    trimmed = strip(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f&&[^\n]]*\n[\s\x1c-\x1f&&[^\n]]*", "\n"))
    return replace_all(trimmed, fixed.HEADING_RULES)


def normalize(text: Column, formula: str = fixed.PROMULGATION) -> Column:
    """Full wikitext to Markdown rewrite."""
    md = headings(clean(crop(text, formula)))
    md = strip(replace_all(md, [fixed.BLANK_RUN]))
    return replace_all(md, fixed.FINISH_RULES)


def with_frontmatter(markdown: Column, frontmatter: str = fixed.FRONTMATTER) -> Column:
    return F.concat(F.lit(frontmatter), F.lit("\n"), markdown, F.lit("\n"))


def count_articles(markdown: Column) -> Column:
    return F.regexp_count(markdown, F.lit(fixed.COUNT_ARTICLES)).cast("bigint")


def count_parts(markdown: Column) -> Column:
    return F.regexp_count(markdown, F.lit(fixed.COUNT_PARTS)).cast("bigint")
