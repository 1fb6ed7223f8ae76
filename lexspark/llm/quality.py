"""Rule bitmask ledger: every quality rule measured once, policies and ablations applied to stored bits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.common import WORD, bind, words


def _repeated_words(hashes: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, given the windows' hashes in order."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(rows: Column) -> Column:
        twice = F.filter(rows, lambda r, k: (F.get(rows, k - 1).h == r.h) | (F.get(rows, k + 1).h == r.h))
        return F.array_sort(F.transform(twice, lambda r: r.i))

    # A window covers three words, or as many as lie before the next repeated window.
    covered = bind(bind(ordered, starts), lambda at: F.aggregate(
        F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x))
    # Most texts repeat no window: they need no sorting.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def _windows(tokens: Column) -> Column:
    """Hashes of the 3-word windows."""
    return F.transform(
        F.when(F.size(tokens) >= 3, F.slice(tokens, 1, F.greatest(F.size(tokens) - 2, F.lit(0)))).otherwise(F.array().cast("array<string>")),
        lambda w, i: F.xxhash64(w, tokens[i + 1], tokens[i + 2]))


def measures(text: Column) -> Column:
    """A struct of what the rules look at; of a null text what an empty one has."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))

    def counted(tokens: Column) -> Column:
        n = F.size(tokens)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            bind(lines, F.size).cast("long").alias("n_lines"),
            bind(_windows(tokens), _repeated_words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(tokens, lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
            F.length(F.regexp_replace(whole, r"[^!]+", "")).cast("long").alias("n_shouts"),
        )

    return bind(words(whole), counted)


@dataclass(frozen=True)
class Rule:
    """A named test that a text fails; ``fails`` gets the struct of ``measures``."""

    name: str
    fails: Callable[[Column], Column]


#: Bit k of a ledger is rule k. Rules are only ever appended, so that stored ledgers keep their meaning.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("duplicate_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("short_or_long_words", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 20 * m.n_words)),
    Rule("few_lettered_words", lambda m: 10 * m.n_lettered < 7 * m.n_words),
    Rule("shouts", lambda m: 10 * m.n_shouts > 3 * m.n_words),
)

#: Versioned policies: the rules that reject.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_or_long_words", "few_lettered_words", "shouts"),
}


def mask(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of a policy, by version or as rule names."""
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in (POLICIES[policy] if isinstance(policy, str) else policy))


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, the measurements, and ``failed``, a bit per rule, for every row.

    Each rule is evaluated once; policies and ablations need the ledger alone. A null or empty text
    has no words, and fails what such a text fails; a null id and repeated rows stay as they are;
    other columns of the input don't matter; no rows give no rows.
    """
    measured = docs.select(F.col(id_column).alias("doc_id"), measures(F.col(text_column)).alias("m"))
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails(F.col("m")), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.select("doc_id", "m", bits.alias("failed")).select("doc_id", "m.*", "failed")


def keep(failed: Column, policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row passes all rules of a policy."""
    return failed.bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(ledger_: DataFrame, policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of a policy: rows it fails, rows only it fails (kept without it), rows all rules keep.

    Rows are counted by their bits first, with a partial step in each task, so whatever the rows only
    as many groups as there are bit patterns are compared with the rules. Without rows all counts are 0.
    """
    bits = mask(policy, rules)
    patterns = ledger_.groupBy(F.col("failed").bitwiseAND(F.lit(bits).cast("long")).alias("p")).agg(F.count("*").alias("n"))
    chosen = [(k, r.name) for k, r in enumerate(rules) if bits >> k & 1]

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n")).otherwise(0)), F.lit(0)).cast("long")

    return patterns.agg(F.array(*(
        F.struct(F.lit(name).alias("rule"), total(F.col("p").bitwiseAND(F.lit(1 << k).cast("long")) != 0).alias("n_failed"),
                 total(F.col("p") == 1 << k).alias("n_only"), total(F.col("p") == 0).alias("n_kept"))
        for k, name in chosen)).alias("rows")).select(F.inline("rows"))
