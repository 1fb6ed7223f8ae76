"""Secret scans with DataFrame functions only: fixed forms, and entropy of sliding windows over candidate strings."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import bind

SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"


@dataclass(frozen=True)
class Form:
    """Matches of a pattern, leftmost and without overlap, whose group has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int
    group: int = 0


@dataclass(frozen=True)
class EntropyClass:
    """Candidate strings over an alphabet; one is reported if some window's entropy, in bits, reaches ``bits``."""

    kind: str
    pattern: str
    alphabet: str
    bits: float
    window: int = 20
    lower: bool = False


#: Fixed values of the base scan.
FORMS: tuple[Form, ...] = (
    Form("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Form("access", r"AKIA[A-Z0-9]+", 20),
    Form("hex", r"[0-9a-f]+", 24),
)
HEX = "0123456789abcdef"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CLASSES: tuple[EntropyClass, ...] = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]{20,}", HEX, 3.0, lower=True),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", BASE64, 3.9),
)
#: A candidate that one of these matches is no secret: stand-ins, identifiers by rule, alphabets in order.
ALLOWED: tuple[str, ...] = (
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
    r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)0123456789|abcdefghij",
)


def _matches(text: Column, pattern: str, group: int, least: int, number: int, kind: str) -> Column:
    """Spans of the matches with ``least`` characters in the group; places are code points."""
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
    gaps = F.split(text, pattern, -1)

    def place(all_: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            begin = state.at + F.length(all_.gaps[k])
            end = begin + F.length(all_.hits[k])
            span = F.struct(begin.alias("start"), F.lit(number).alias("kind_no"), end.alias("end"), F.lit(kind).alias("kind"))
            kept = F.length(all_["values"][k]) >= least
            return F.struct(end.alias("at"), F.when(kept, F.concat(state.spans, F.array(span))).otherwise(state.spans).alias("spans"))

        first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(all_.hits) - 1), first, step, lambda s: s.spans)

    found = bind(F.struct(gaps.alias("gaps"), hits.alias("hits"), values.alias("values")), place)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPANS))


def _f(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(value: Column, of: EntropyClass) -> Column:
    """The largest Shannon entropy of a window of a string, by counts that change as the window moves; shorter strings have none (0)."""
    size = len(of.alphabet)
    letter = lambda k: F.position(F.substring(value, k, F.lit(1)), F.lit(of.alphabet))
    first = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("most"))

    def move(state: Column, into: Column, out: Column) -> Column:
        def changed(c: Column, k: Column) -> Column:
            return c + F.when(k + 1 == into, 1).otherwise(0) - F.when(k + 1 == out, 1).otherwise(0)

        more, fewer = F.get(state.counts, into - 1), F.get(state.counts, out - 1)
        gain = F.when(into == out, F.lit(0.0)).otherwise(
            F.coalesce(_f(more + 1) - _f(more), F.lit(0.0)) + F.coalesce(_f(fewer - 1) - _f(fewer), F.lit(0.0)))
        return F.struct(F.transform(state.counts, changed).alias("counts"), (state["sum"] + gain).alias("sum"))

    def step(state: Column, k: Column) -> Column:
        out = F.when(k > of.window, letter(k - of.window)).otherwise(F.lit(0))
        return bind(F.struct(letter(k).alias("into"), out.alias("out")), lambda x: bind(move(state, x["into"], x["out"]), lambda m: F.struct(
            m.counts.alias("counts"), m["sum"].alias("sum"),
            F.when(k >= of.window, F.greatest(state.most, F.lit(math.log2(of.window)) - m["sum"] / of.window)).otherwise(state.most).alias("most"))))

    return F.when(F.length(value) >= of.window, F.aggregate(F.sequence(F.lit(1), F.length(value)), first, step, lambda s: s.most)).otherwise(F.lit(0.0))


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", forms: Sequence[Form] = FORMS, classes: Sequence[EntropyClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """``doc_id, base, added`` for every row: spans (``start, kind_no, end, kind``) of the forms and of the entropy classes.

    A candidate of a class needs a letter and a digit, a window of enough entropy, and no match of
    the allow-list, and must not lie within a span of a form or of an earlier class. Base spans are
    never suppressed. A null or empty text has no spans; rows with equal or null ids stay rows of
    their own; other columns of the input don't matter; no rows give no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    found = rows.select("doc_id", "text", F.array_sort(F.concat(*(_matches(F.col("text"), f.pattern, f.group, f.least, k, f.kind) for k, f in enumerate(forms)))).alias("base"))

    def secret(span: Column, of: EntropyClass) -> Column:
        def judged(value: Column) -> Column:
            good = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            for pattern in allowed:
                good = good & ~value.rlike(pattern)
            return good & F.when(good, window_entropy(F.lower(value) if of.lower else value, of) >= of.bits).otherwise(F.lit(False))

        return bind(F.substring(F.col("text"), (span.start + 1).cast("int"), (span.end - span.start).cast("int")), judged)

    covered = "base"
    for k, of in enumerate(classes):
        spans = F.filter(_matches(F.col("text"), of.pattern, 0, of.window, len(forms) + k, of.kind), lambda x: ~F.exists(covered, lambda b: (b.start <= x.start) & (b.end >= x.end)) & secret(x, of))
        found = found.withColumn(f"{covered}_", F.concat(covered, spans))
        covered = f"{covered}_"
    return found.select("doc_id", "base", F.array_sort(F.filter(covered, lambda x: x.kind_no >= len(forms))).alias("added"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``doc_id, text`` with every span of ``scan`` replaced by a mark; for tables whose ids are unique."""
    every = F.array_sort(F.concat("base", "added"))

    def step(state: Column, s: Column) -> Column:
        new = s.start >= state.at
        return F.struct(
            F.greatest(state.at, s.end).alias("at"),
            F.when(new, F.concat(state.out, F.substring(F.col("t"), (state.at + 1).cast("int"), (s.start - state.at).cast("int")), F.lit(mark))).otherwise(state.out).alias("out"))

    joined = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("t")).join(spans.select("doc_id", every.alias("every")), "doc_id")
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return joined.select("doc_id", F.aggregate("every", first, step, lambda s: F.concat(s.out, F.substring(F.col("t"), (s.at + 1).cast("int"), F.length("t")))).alias("text"))
