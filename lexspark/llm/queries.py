"""Registered queries of the subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import align, bpe, chat, decontaminate, html, langid, licenses, linedup, merkle, quality, secrets, simhash, warc
from lexspark.llm.common import lower_ascii, table


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CATALOG: dict[str, Query] = {}

#: The vocabulary of the BPE queries: tokenizers file, ranks, pattern.
VOCABULARY = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

#: The two tokenizers of the alignment; their files are looked up where a task runs.
TOKENIZERS = align.Names("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", public_tokenizers.PATTERN, "piece_bpe_32k.model", public_tokenizers.path)


def _query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        CATALOG[name] = Query(run, sql)
        return run

    return register


@_query("op1_chat_windows", r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT *, row_number() OVER o - 1 AS k, coalesce(sum(tok) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tok,
      16 + length(role) + length(replace(replace(replace(text, '\', '\\'), '<turn:', '<\turn:'), '</turn>', '<\/turn>')) AS chars FROM t)
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (SELECT conv_id, min(k) FILTER (role = 'system') AS sys, greatest(768 - coalesce(arg_min(tok, k) FILTER (role = 'system'), 0), 1) AS room,
    coalesce(arg_min(chars, k) FILTER (role = 'system'), 0) AS sys_chars FROM s GROUP BY conv_id),
w AS (
  SELECT conv_id, k, k AS first, before AS base FROM s WHERE k = 0
  UNION ALL
  SELECT s.conv_id, s.k, CASE WHEN s.before + s.tok - w.base > c.room THEN s.k ELSE w.first END, CASE WHEN s.before + s.tok - w.base > c.room THEN s.before ELSE w.base END
  FROM w JOIN s ON s.conv_id = w.conv_id AND s.k = w.k + 1 JOIN c ON c.conv_id = s.conv_id),
starts AS (SELECT DISTINCT conv_id, first FROM w),
h AS (
  SELECT conv_id, first, sum(chars) AS chars FROM (
    SELECT x.conv_id, x.first, s.chars, row_number() OVER r AS n, sum(s.tok) OVER r AS tok
    FROM starts x JOIN s ON s.conv_id = x.conv_id AND s.k < x.first AND s.role <> 'system' WINDOW r AS (PARTITION BY x.conv_id, x.first ORDER BY s.k DESC))
  WHERE n <= 4 AND tok <= 256 GROUP BY conv_id, first),
f AS (
  SELECT x.conv_id, CAST(sum(coalesce(h.chars, 0) + CASE WHEN x.first > c.sys THEN c.sys_chars ELSE 0 END) AS BIGINT) AS chars, count(*) AS n_windows
  FROM starts x LEFT JOIN h ON h.conv_id = x.conv_id AND h.first = x.first JOIN c ON c.conv_id = x.conv_id GROUP BY x.conv_id)
SELECT s.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(s.chars) + any_value(f.chars) AS BIGINT) AS formatted_chars, any_value(f.n_windows) AS n_windows
FROM s JOIN f ON f.conv_id = s.conv_id GROUP BY s.conv_id""")
def op1_chat_windows(spark: SparkSession, root: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, root, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.conversations_read_back(chat.format_windows(turns, budget=1024, history_tokens=256, history_turns=4))


@_query("op4_quality_ledger", r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS grams, row_number() OVER () AS n FROM w),
g AS (SELECT n, unnest(grams) AS gram, unnest(range(len(grams))) AS i FROM l),
r AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT n, count(DISTINCT p) AS repeated FROM (SELECT n, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY n),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(repeated, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS BIGINT) AS n_lettered, CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS BIGINT) AS n_shouts
  FROM l LEFT JOIN c USING (n)),
b AS (SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_lettered < 7 * n_words THEN 32 ELSE 0 END
  + CASE WHEN 10 * n_shouts > 3 * n_words THEN 64 ELSE 0 END AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM b""")
def op4_quality_ledger(spark: SparkSession, root: str) -> DataFrame:
    made = quality.ledger(table(spark, root, "documents"))
    return made.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.keep(F.col("failed"), "base")).alias("base_failed"), quality.keep(F.col("failed"), "v2").alias("kept"), "failed")


@_query("op5_simhash")
def op5_simhash(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"), radius=3)


@_query("op7_bpe")
def op7_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe.encode(table(spark, root, "documents"), VOCABULARY, keep_ids=False)


@_query("op6_secrets", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
p(kind, no, pat, least, grp) AS (VALUES
  ('assign', 0, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6, 2), ('access', 1, 'AKIA[A-Z0-9]+', 20, 0),
  ('hex', 2, '[0-9a-f]+', 24, 0), ('entropy_hex', 3, '[0-9A-Fa-f]{20,}', 20, 0), ('entropy_base64', 4, '[A-Za-z0-9+/_-]{20,}', 20, 0)),
s AS (SELECT n, t, kind, no, least, string_split_regex(t, pat) AS gaps, regexp_extract_all(t, pat) AS hits,
  CASE WHEN grp = 2 THEN regexp_extract_all(t, pat, 2) ELSE regexp_extract_all(t, pat) END AS vals FROM d, p),
m AS (SELECT n, kind, no, hit AS value, CAST(list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start, length(hit) AS size
  FROM (SELECT n, kind, no, least, gaps, hits, unnest(hits) AS hit, unnest(vals) AS val, unnest(range(1, len(hits) + 1)) AS i FROM s) WHERE length(val) >= least),
e AS (SELECT *, list_max(list_transform(range(1, length(value) - 18), lambda i: list_aggregate(string_split(CASE WHEN no = 3 THEN lower(value[i:i + 19]) ELSE value[i:i + 19] END, ''), 'entropy'))) AS bits
  FROM m WHERE no >= 3 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT regexp_matches(value, '(?i)example|sample|dummy|placeholder|changeme|xxxx')
  AND NOT regexp_matches(value, '^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$') AND NOT regexp_matches(value, '(?i)0123456789|abcdefghij')),
b AS (SELECT n, kind, no, start, start + size AS stop FROM m WHERE no < 3),
h AS (SELECT n, kind, no, start, start + size AS stop FROM e WHERE no = 3 AND bits >= 3.0 AND NOT EXISTS (SELECT 1 FROM b WHERE b.n = e.n AND b.start <= e.start AND b.stop >= e.start + e.size)),
x AS (SELECT * FROM b UNION ALL SELECT * FROM h),
a AS (SELECT * FROM x UNION ALL SELECT n, kind, no, start, start + size FROM e WHERE no = 4 AND bits >= 3.9 AND NOT EXISTS (SELECT 1 FROM x WHERE x.n = e.n AND x.start <= e.start AND x.stop >= e.start + e.size)),
r AS (SELECT n, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) FILTER (no < 3) AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans FROM a GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (n)""")
def op6_secrets(spark: SparkSession, root: str) -> DataFrame:
    found = secrets.scan(table(spark, root, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.concat("base", "added")).alias("spans"))


def trained_language_model(docs: DataFrame) -> langid.Model:
    """The language model, from the documents that are not held out."""
    return langid.train(docs.where(~_held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))


def _held_out():
    """Whether a document is held out; one without id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@_query("op10_language")
def op10_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    made = langid.identify(docs.select("doc_id", "text", _held_out().alias("held_out")), trained_language_model(docs))
    return made.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@_query("op2_main_text")
def op2_main_text(spark: SparkSession, root: str) -> DataFrame:
    return html.extract(table(spark, root, "pages"))


@_query("op8_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
b AS (SELECT page_id, html, first, array_to_string(list_transform(string_split(h, ''), lambda c:
  ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', c)]), '') AS bits
  FROM p JOIN f USING (h))
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(5),
    lambda k: CASE WHEN substr(bits, CAST(5 * i + k + 1 AS BIGINT), 1) = '1' THEN 1 << (4 - k) ELSE 0 END)) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM b""")
def op8_warc(spark: SparkSession, root: str) -> DataFrame:
    return warc.round_trip(table(spark, root, "pages"), min_bytes=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op3_decontamination")
def op3_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.matches(table(spark, root, "documents"), table(spark, root, "benchmark"))


@_query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    return linedup.match_lines(table(spark, root, "documents")).select("doc_id", "line_no", "class_id", "n_links", "removed")


def _merkle_sql(levels: int = 12, langs: int = 4) -> str:
    """The trees level by level: ``levels`` of them hold ``8 ** levels`` documents, ``langs`` as many languages.

    ``t`` numbers nodes of each tree, ``s`` has the digests to the left and right of each in its run.
    """
    def tree(name: str, source: str, depth: int) -> list[str]:
        steps = [f"{name}0 AS ({source})"]
        for k in range(depth):
            own = "OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
            steps += [
                f"{name}s{k} AS (SELECT tree, pos, n, coalesce(string_agg(h, '') {own} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {own} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})",
                f"{name}{k + 1} AS (SELECT tree, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (any_value(n) + 7) // 8 AS n FROM {name}{k} GROUP BY tree, pos // 8)",
            ]
        return steps

    def folds(name: str, source: str, tree_: str, key: str, pos: str, depth: int) -> list[str]:
        steps = [f"{name}0 AS ({source})"]
        for k in range(depth):
            steps.append(
                f"{name}{k + 1} AS (SELECT p.* EXCLUDE (proof, folded), p.proof || s.l || s.r AS proof, CASE WHEN s.n = 1 THEN p.folded ELSE sha256(s.l || p.folded || s.r) END AS folded "
                f"FROM {name}{k} p JOIN {tree_}s{k} s ON s.tree = p.{key} AND s.pos = p.{pos} // {8 ** k})")
        return steps

    value = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    row = lambda text: f"sha256({' || '.join(map(value, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    crc = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"d AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, {row('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {row(lower)} ELSE {row('text')} END AS shown FROM documents)",
        "e AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d)",
        *tree("t", "SELECT tree, pos, leaf AS h, n FROM e", levels),
        *tree("u", f"SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, h, count(*) OVER () AS n, tree AS of FROM t{levels}", langs),
        *folds("p", "SELECT *, '' AS proof, shown AS folded FROM e", "t", "tree", "pos", levels),
        *folds("q", f"SELECT p.*, u.pos AS top, '' AS none, u.h AS subroot FROM p{levels} p JOIN u0 u ON u.of = p.tree", "u", "none", "top", langs),
    ]
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.h AS verified FROM q{langs}, u{langs} u"


@_query("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    shown = {"text": F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))}
    made = merkle.manifest(merkle.leaves_of(docs, ("doc_id", "source", "lang", "n_chars", "text"), shown))
    return made.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"), "folded_root", "verified")


def _licenses_sql() -> str:
    grams = ", ".join(
        f"({n}, {i}, '{' '.join(t.words[i:i + t.k])}', {t.k})" for n, t in enumerate(licenses.TEMPLATES) for i in range(len(t.words) - t.k + 1))
    facts = ", ".join(f"({n}, '{t.label}', {t.phrase}, {t.base}, {len(t.words)})" for n, t in enumerate(licenses.TEMPLATES))
    return rf"""
WITH g(template, q, gram, k) AS (VALUES {grams}), f(template, label, phrase, base, length) AS (VALUES {facts}),
d AS (SELECT *, row_number() OVER () AS n FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
e AS (SELECT n, unnest(range(1, len(w) + 1)) AS p, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i] || ' ' || w[i + 1])) AS two,
  unnest(list_transform(range(1, len(w) + 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS three FROM d),
h AS (SELECT n, template, p - 1 - q AS diagonal, q, g.k FROM e JOIN g ON g.gram = CASE WHEN g.k = 2 THEN e.two ELSE e.three END),
m AS (SELECT n, template, diagonal, count(*) AS hits, any_value(k) AS k FROM h GROUP BY n, template, diagonal),
c AS (SELECT m.n, m.template, m.diagonal, count(DISTINCT h.q + o.i) AS covered
  FROM m JOIN h ON h.n = m.n AND h.template = m.template AND abs(h.diagonal - m.diagonal) <= {licenses.REACH}, range(3) o(i) WHERE o.i < h.k GROUP BY m.n, m.template, m.diagonal),
s AS (SELECT m.n, m.diagonal, f.label, f.base, CASE WHEN phrase THEN hits = length - k + 1 ELSE covered >= {licenses.SHARE} * length END AS whole,
    CASE WHEN phrase THEN CASE WHEN hits = length - k + 1 THEN 1.0 ELSE 0.0 END ELSE CAST(covered AS DOUBLE) / length END AS share
  FROM m JOIN c USING (n, template, diagonal) JOIN f USING (template)),
r AS (SELECT n, count(*) FILTER (whole AND base) AS n_base, min(diagonal) FILTER (whole AND base) AS first_word, max(diagonal) FILTER (whole AND base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole AND base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS labels, max(CAST(share AS DOUBLE)) AS score FROM s GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN r USING (n)"""


@_query("op13_licenses", _licenses_sql())
def op13_licenses(spark: SparkSession, root: str) -> DataFrame:
    found = licenses.scan(table(spark, root, "documents"))
    starts = F.transform(F.filter("spans", lambda s: s.base), lambda s: s.start)
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        licenses.labels(F.col("spans"), base_only=True).alias("base_labels"), licenses.labels(F.col("spans")).alias("labels"), "score")


@_query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    return align.align(table(spark, root, "documents"), TOKENIZERS)
