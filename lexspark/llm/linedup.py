"""Line dedup by an exact set-similarity join of lines, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import SPACE, WORD, bind, fresh, stash

#: Words of a shingle, and the Jaccard similarity from which lines match.
WORDS, SIMILARITY = 5, 0.8
#: Buckets in which shingles are counted: the table of counts has this size whatever the corpus.
BUCKETS = 1 << 17
#: Buckets counted in one row of the aggregation; with one a row, the keys outgrow the hash table of Spark's generated code.
LANES = 8
#: Bits of the table that tells which lines are candidates, likewise of one size.
BITS = 1 << 23
#: Places of a prefix between two parities, and how many such steps have one.
STEP, STEPS = 1, 12


def _unusual(text: Column) -> Column:
    """Whether a text has white space other than spaces and line ends."""
    # Split once, as that searches many bytes at a time; ``contains`` goes byte by byte.
    return reduce(Column.__or__, (F.size(F.split(text, mark, 2)) > 1 for mark in "\t\v\f\r"))


def tidy(line: Column, unusual: Column | None = None) -> Column:
    """The words of a line with single spaces. Say ``unusual`` is false, and spaces are its only white space."""
    # Most lines are tidy, which a search for bytes tells faster than a pattern.
    odd = line.startswith(" ") | line.endswith(" ") | line.contains("  ") | (_unusual(line) if unusual is None else unusual)
    return F.when(odd, F.trim(F.regexp_replace(line, SPACE, " "))).otherwise(line)


def shingles(line: Column, words: int = WORDS) -> Column:
    """The distinct word shingles of a tidy line; of a shorter line the line itself, of a blank one none."""
    # Spelled out and possessive, the pattern has neither a loop of groups nor a way back to remember.
    every = F.regexp_extract_all(line, F.lit("(?=(%s))[^ ]++" % " ".join(["[^ ]++"] * words)), F.lit(1))
    return bind(every, lambda s: F.when(F.size(s) > 0, F.array_distinct(s)).when(line != "", F.array(line)).otherwise(F.slice(s, 1, 0)))


def _word_hashes(line: Column) -> Column:
    return F.transform(F.split(line, " "), lambda w: F.xxhash64(w))


def _places(hashes: Column, words: int) -> Column:
    """Where the shingles of a line begin."""
    return F.sequence(F.lit(0), F.greatest(F.size(hashes) - words, F.lit(0)))


def _hash(hashes: Column, at: Column, words: int) -> Column:
    """The hash of a shingle from those of its words; of a shorter line that of all its words."""
    return F.xxhash64(*(F.get(hashes, at + k if k else at) for k in range(words)))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def lines_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``pos, row, line_no, worded, class, line`` of every line: its place in the corpus, its row, and its words.

    Lines with the same words in the same order are a class.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    # What is about the whole text is projected below the explode, else it would be computed again for each line.
    whole = docs.select(F.col(id_column).alias("doc_id"), row_key(id_column, text_column).alias("row"), text.alias("text"), _unusual(text).alias("unusual"))
    cut = whole.select("doc_id", "row", "unusual", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    # Whether a line has a word is asked of the raw line, so that a filter below doesn't tidy each line once more.
    made = cut.select("doc_id", "row", F.col("line_no").cast("long").alias("line_no"), F.col("raw").rlike(WORD).alias("worded"), tidy(F.col("raw"), F.col("unusual")).alias("line"))
    return made.select(
        F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row", "line_no").alias("pos"), "row", "line_no", "worded",
        F.when(F.col("worded"), F.xxhash64("line")).alias("class"), "line")


def row_key(id_column: str, text_column: str) -> Column:
    return F.xxhash64(F.col(id_column).cast("string"), F.col(text_column).cast("string"))


def _rarities(lines: DataFrame, words: int) -> Column:
    """An array, as a scalar: for each bucket of shingles a class of how many there are over all lines, in the highest bits."""
    split = lines.where("worded").select(_word_hashes(F.col("line")).alias("w"))
    bucket = split.select("w", F.explode(_places(F.col("w"), words)).alias("at")).select(_bucket(_hash(F.col("w"), F.col("at"), words)).alias("bucket"))
    lane = F.col("bucket").bitwiseAND(F.lit(LANES - 1))
    counts = bucket.groupBy(F.shiftright("bucket", LANES.bit_length() - 1).cast("long").alias("id")).agg(*(F.count(F.when(lane == k, 1)).alias(f"n{k}") for k in range(LANES)))
    ranks = F.array(*(F.shiftleft(F.floor(4 * F.log2(F.coalesce(f"n{k}", F.lit(0)) + 1)), 55) for k in range(LANES)))
    dense = lines.sparkSession.range(BUCKETS // LANES).join(counts, "id", "left").select(F.struct("id", ranks.alias("ranks")).alias("x"))
    return dense.agg(F.flatten(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["ranks"])).alias("ranks")).scalar()


def _members(ids: DataFrame, bits: int = BITS):
    """A test whether an id is among ``ids``, wrong only in that it lets others pass; the table it uses has a fixed size."""
    place = F.pmod(F.col("id"), F.lit(bits))
    words = ids.select(F.floor(place / 64).alias("id"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("word"))
    dense = ids.sparkSession.range(bits // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("x"))
    table = dense.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["word"]).alias("words")).scalar()

    def test(value: Column) -> Column:
        at = F.pmod(value, F.lit(bits))
        return F.get(table, F.floor(at / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))) != 0

    return test


def _prefixes(lines: DataFrame, words: int, similarity: float) -> DataFrame:
    """``token, class, shape, parity, last`` for the rarest shingles of each class: as many as a match must share one of.

    ``shape`` is size and place; ``last`` is the shingle before. ``parity`` is about the shingles from
    the latest step of places on: a bit for each 64th of the hashes, set if an odd number of them fall there.
    """
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    # Repeats go and tokens are sorted outside any lambda, so that generated code does it on plain longs; words are bound, and no cell.
    split = bind(_word_hashes(F.col("line")), lambda w: F.transform(_places(w, words), lambda at: _hash(w, at, words)))
    hashed = lines.where("worded").select("class", F.array_distinct(split).alias("hashes"))
    # A byte a bucket, so that the table stays in a core's own cache; a class is 252 at most.
    table = lines.sparkSession.range(1).select(_rarities(lines, words).alias("ranks"))
    narrow = table.select(F.transform("ranks", lambda x: (F.shiftright(x, 55) - 128).cast("byte")).alias("ranks"))
    # Named in a projection of its own and mentioned once, the table of ranks is inlined and never becomes a row's cell.
    ranked = hashed.select("class", "hashes", narrow.scalar().alias("ranks"))
    # Nulls, which there are none of, are ruled out, or else the sort would be one of objects.
    tokens = F.transform("hashes", lambda h: F.coalesce(F.shiftleft(F.col("ranks")[_bucket(h)].cast("long"), 55).bitwiseOR(h.bitwiseAND(F.lit((1 << 55) - 1))), h))
    whole = F.aggregate("hashes", F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(bit(h)))
    size = F.size("hashes")
    cut = F.struct(size.alias("size"), whole.alias("parity"), F.slice(F.sort_array(tokens), 1, size - F.ceil(size * similarity - 1e-9).cast("int") + 1).alias("prefix"))
    # Equal lines fold into one row in each task first, so a line that fills a third of the corpus is shuffled once a task.
    classes = ranked.select("class", cut.alias("cut")).groupBy("class").agg(F.min("cut").alias("cut"))
    steps = classes.select("class", F.col("cut.size").cast("long").alias("size"), F.col("cut.prefix").alias("prefix"), F.col("cut.parity").alias("p0"))
    for k in range(1, STEPS + 1):
        left = F.col(f"p{k - 1}")
        for i in range((k - 1) * STEP, k * STEP):
            left = left.bitwiseXOR(F.coalesce(bit(F.get("prefix", F.lit(i))), F.lit(0).cast("long")))
        steps = steps.withColumn(f"p{k}", left)
    # An expression, not a column, is exploded, so that no filter is inferred and computed below.
    rows = steps.select("*", F.posexplode(F.slice("prefix", 1, F.size("prefix"))).alias("place", "token"))
    parity = F.col("p0")
    for k in range(1, STEPS + 1):
        parity = F.when(F.col("place") >= k * STEP, F.col(f"p{k}")).otherwise(parity)
    return rows.select(
        "token", "class", F.shiftleft("size", 32).bitwiseOR(F.col("place").cast("long")).alias("shape"), parity.alias("parity"),
        F.coalesce(F.get("prefix", F.col("place") - 1), F.lit(0).cast("long")).alias("last"))


def _candidates(prefixes: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: classes that share a rare shingle and pass the length and positional filters."""
    # Few shingles are in two classes. The others go first, after one sort of all, where the join would sort them twice and meet each with itself.
    of = Window.partitionBy("token")
    shared = prefixes.select("*", F.min("class").over(of).alias("low"), F.max("class").over(of).alias("high")).where("low < high").drop("low", "high")
    shared = stash(shared, "linedup")
    a, b = shared.alias("a"), shared.alias("b")
    size = lambda x: F.shiftright(f"{x}.shape", 32)
    place = lambda x: F.col(f"{x}.shape").bitwiseAND(F.lit((1 << 32) - 1))
    needed = (size("a") + size("b")) * (similarity / (1 + similarity)) - 1e-9
    # Say this is the first shingle both have. Then they share no more than either has from here on; and
    # those before the step it is in, and at least one for each bit that differs from there on, are in one
    # of them only. A match passes at its first shared shingle, whatever becomes of it at others. Among
    # thousands of edited copies of a line the bits tell most of those that miss.
    step = lambda x: F.least(F.floor(place(x) / STEP), F.lit(STEPS)) * STEP
    most = F.least(size("a") - place("a"), size("b") - place("b"))
    apart = step("a") + step("b") + F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity")))
    # With the same shingle before it in both, it is no first one.
    later = (F.col("a.last") == F.col("b.last")) & (place("a") > 0) & (place("b") > 0)
    return a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.class") < F.col("b.class"))
                  & (size("a") >= size("b") * similarity - 1e-9) & (size("b") >= size("a") * similarity - 1e-9) & (most >= needed)
                  & (size("a") + size("b") - apart >= 2 * needed) & ~later).select(
        F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct()


def links(lines: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b``: every two classes of lines whose sets of shingles are at least so similar, verified on the shingles themselves."""
    pairs = stash(_candidates(_prefixes(lines, words, similarity), similarity), "linedup")
    chosen = _members(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))))
    texts = lines.where("worded").where(chosen(F.col("class"))).groupBy("class").agg(F.min("line").alias("line"))
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("class").alias("b"), F.col("line").alias("y")), "b")

    def similar(s: Column) -> Column:
        return bind(F.size(F.array_intersect(s.x, s.y)), lambda n: n >= (F.size(s.x) + F.size(s.y) - n) * similarity - 1e-9)

    return both.where(bind(F.struct(shingles(F.col("x"), words).alias("x"), shingles(F.col("y"), words).alias("y")), similar)).select("a", "b")


def match_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each line: ``doc_id, row, line_no, class_id, n_links, removed``.

    Lines match if their sets of five-word shingles have a Jaccard similarity of 0.8 or more; a
    shorter line is one shingle. Lines with the same words are a class (``class_id``); ``n_links``
    is the number of other classes that match it. A line is ``removed`` if an earlier line matches
    it, whether that one stays or not. Lines go by doc_id (nulls last), then row, then ``line_no``;
    ``row`` is a hash of id and text, so rows equal in both are one document and keep the same
    lines. Blank lines have no class and stay. A null text is one blank line; other columns of the
    input don't matter; no rows give no rows.
    """
    lines = lines_of(docs, id_column, text_column)
    places = stash(lines.select("pos", "class"), "linedup")
    first = places.where("class IS NOT NULL").groupBy("class").agg(F.min("pos").alias("pos"))
    found = stash(links(lines, words, similarity), "linedup")
    near = found.select(F.col("a").alias("class"), F.col("b").alias("other")).union(found.select(F.col("b").alias("class"), F.col("a").alias("other")))
    linked = near.join(first.select(F.col("class").alias("other"), F.col("pos").alias("other_pos")), "other").groupBy("class").agg(
        F.count("*").alias("n_links"), F.min("other_pos").alias("other_pos"))
    # Written first: read back, both sides of the join below are plain, and a line of many copies can be split over tasks.
    judged = stash(first.join(linked, "class", "left").select(
        "class", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.least("pos", "other_pos").alias("first_pos")), "linedup")
    return places.join(judged, "class", "left").select(
        F.col("pos.doc_id").alias("doc_id"), F.col("pos.row").alias("row"), F.col("pos.line_no").alias("line_no"), F.col("class").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce(F.col("first_pos") < F.col("pos"), F.lit(False)).alias("removed"))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all rows and columns, without the lines that match an earlier one; see ``match_lines``. A null text stays null."""
    key, gone = fresh("row"), fresh("gone")
    removed = match_lines(docs, id_column, text_column, words, similarity).where("removed").groupBy(F.col("row").alias(key)).agg(F.collect_set("line_no").alias(gone))
    keyed = docs.withColumn(key, row_key(id_column, text_column)).join(removed, key, "left")
    kept = F.array_join(F.filter(F.split(F.col(text_column).cast("string"), "\n"), lambda x, k: ~F.array_contains(gone, k.cast("long"))), "\n")
    return keyed.withColumn(text_column, F.when(F.col(gone).isNull(), F.col(text_column)).otherwise(kept)).select(*(F.col(f"`{c}`") for c in docs.columns))
