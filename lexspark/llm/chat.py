"""Chat formatting in budgeted windows, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm.common import bind

#: Turn numbers that one block of a conversation spans; a window never crosses blocks, so a
#: conversation of any length is formatted in parts of bounded size.
BLOCK = 1024


@dataclass(frozen=True)
class Template:
    """Marks around a turn: ``opening``, the role, ``after_role``, the text, ``closing``.

    Inside roles and texts the marks are escaped by a backslash after their first character, and
    backslashes are doubled, so no mark stands in an escaped text and every text can be read back.
    ``after_role`` may stand in texts: a turn's first one ends its role. No mark may hold a
    backslash; ``closing`` may hold no start of its own again.
    """

    opening: str = "<turn:"
    after_role: str = ">\n"
    closing: str = "</turn>\n"
    controls: tuple[str, ...] = ("<turn:", "</turn>")

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for mark in self.controls:
            out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
        return out

    def escape_role(self, role: Column) -> Column:
        """As a text, and with the mark after roles broken up as well."""
        return F.replace(self.escape(role), F.lit(self.after_role), F.lit(self.after_role[0] + "\\" + self.after_role[1:]))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"\\([\s\S])", "$1")

    def read(self, formatted: Column) -> Column:
        """The turns of a formatted text: structs of role and text."""
        bodies = F.split(formatted, "\\Q" + self.closing + "\\E")
        turns = F.slice(bodies, 1, F.greatest(F.size(bodies) - 1, F.lit(0)))
        skip = len(self.opening)

        def turn(body: Column) -> Column:
            end = F.locate(self.after_role, body)
            return F.struct(
                self.unescape(F.substring(body, F.lit(skip + 1), end - 1 - skip)).alias("role"),
                self.unescape(F.substring(body, end + len(self.after_role), F.length(body))).alias("text"))

        return F.transform(turns, turn)


def about_four_characters(text: Column) -> Column:
    """Tokens of a text, at four code points each."""
    return F.ceil(F.length(text) / 4).cast("long")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _spans(prefix: Column, room: Column) -> Column:
    """Turn-aligned spans ``(first, last)``, 0-based: each takes turns while their prefix sums stay within the room.

    ``prefix[k]`` is the sum of the tokens before turn k. A turn beyond the room is a span of its own.
    """
    start = F.struct(F.lit(0).alias("first"), F.array().cast("array<struct<first:int,last:int>>").alias("done"))

    def step(state: Column, k: Column) -> Column:
        full = (prefix[k + 1] - prefix[state.first] > room) & (k > state.first)
        return F.struct(
            F.when(full, k).otherwise(state.first).alias("first"),
            F.when(full, F.concat(state.done, F.array(F.struct(state.first.alias("first"), (k - 1).alias("last"))))).otherwise(state.done).alias("done"))

    n = F.size(prefix) - 1
    return F.aggregate(
        F.sequence(F.lit(0), n - 1), start, step,
        lambda s: F.concat(s.done, F.array(F.struct(s.first.alias("first"), (n - 1).alias("last")))))


def format_windows(
    turns: DataFrame, budget: int = 1024, history_tokens: int = 256, history_turns: int = 4, target_role: str = "assistant", system_role: str = "system",
    template: Template = Template(), tokens: Callable[[Column], Column] = about_four_characters, block: int = BLOCK,
) -> DataFrame:
    """Windows of conversations (``conv_id, turn, role, text``), a row each.

    ``conv_id, block, window, formatted, n_turns, n_repeated, loss_spans, n_tokens``: windows come in
    the order of ``block, window``. A window holds the conversation's system turn, a limited history
    (the latest turns before it but system turns, up to ``history_turns`` and ``history_tokens``), and new turns, up
    to ``budget`` tokens together; one new turn beyond that is a window of its own. The first
    ``n_repeated`` turns are repeated from before. ``loss_spans`` (code points, end exclusive) cover
    the texts of new ``target_role`` turns only, so each is a target once.

    Turns go by ``turn`` (nulls last), then role, then text; repeated rows stay. Null texts and roles
    count as empty. A null conv_id is a conversation like any other. The system turn is the first
    one of that role. Other columns of the input don't matter; no rows give no rows.
    """
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    number = F.coalesce(F.floor(F.col("turn") / block).cast("long"), F.lit((1 << 62) // block))
    entry = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text")
    placed = rows.select("conv_id", number.alias("block"), F.lit(False).alias("extra"), entry.alias("entry"))
    # Blocks after the first see the first system turn and the last turns of the block before.
    blocks = placed.select("conv_id", "block").distinct().withColumn("before", F.lag("block").over(Window.partitionBy("conv_id").orderBy("block"))).where(F.col("before").isNotNull())
    first_system = rows.where(F.col("role") == system_role).groupBy("conv_id").agg(F.min(entry).alias("entry"))
    systems = blocks.join(first_system, F.equal_null(blocks.conv_id, first_system.conv_id)).where(
        F.coalesce(F.floor(F.col("entry.turn") / block).cast("long"), F.lit((1 << 62) // block)) < F.col("block")).select(
        blocks.conv_id, "block", F.lit(True).alias("extra"), "entry")
    tails = placed.alias("p").join(blocks.alias("b"), F.equal_null("p.conv_id", "b.conv_id") & (F.col("p.block") == F.col("b.before"))).where(
        F.pmod("p.entry.turn", F.lit(block)) >= block - history_turns).select("b.conv_id", "b.block", F.lit(True).alias("extra"), "p.entry")
    grouped = placed.union(systems).union(tails).groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("extra", "entry"))).alias("all"))

    def piece(x: Column) -> Column:
        head = F.concat(F.lit(template.opening), template.escape_role(x.entry.role), F.lit(template.after_role))
        return F.struct(
            x.extra.alias("extra"), head.alias("head"), template.escape(x.entry.text).alias("body"), (x.entry.role == target_role).alias("target"),
            (x.entry.role == system_role).alias("system"), tokens(x.entry.text).alias("tokens"))

    prepared = grouped.select("conv_id", "block", F.transform("all", piece).alias("all")).select(
        "conv_id", "block", F.filter("all", lambda x: ~x.extra).alias("own"),
        F.filter("all", lambda x: x.extra & ~x.system).alias("tail"),
        F.slice(F.filter("all", lambda x: x.extra & x.system), 1, 1).alias("before"),
        F.slice(F.filter("all", lambda x: x.system), 1, 1).alias("inside"),
        F.array_position(F.transform(F.filter("all", lambda x: ~x.extra), lambda x: x.system), True).cast("int").alias("place"))
    prepared = prepared.select(
        "conv_id", "block", "own", "tail",
        F.when(F.size("before") > 0, 0).otherwise(F.col("place")).alias("system_at"),
        F.when(F.size("before") > 0, F.col("before")).otherwise(F.col("inside")).alias("system"),
        F.aggregate("own", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x.tokens))).alias("prefix"))
    room = F.greatest(F.lit(budget - history_tokens) - _sum(F.transform("system", lambda x: x.tokens)), F.lit(1))
    spans = prepared.withColumn("room", room).withColumn("spans", _spans(F.col("prefix"), F.col("room")))
    # Every block has spans. An inner explode of a column would bring a filter that is computed, spans and all, below.
    cut = spans.select("*", F.posexplode_outer("spans").alias("window", "span")).drop("spans")

    # The history of a span: the latest turns before it, while the limits hold.
    earlier = F.filter(F.concat("tail", F.slice("own", 1, F.col("span.first"))), lambda x: ~x.system)
    latest = bind(earlier, lambda c: F.slice(c, F.greatest(F.size(c) - history_turns + 1, F.lit(1)), history_turns))
    history = bind(latest, lambda c: F.filter(c, lambda x, k: _sum(F.transform(F.slice(c, k + 1, F.size(c)), lambda y: y.tokens)) <= history_tokens))
    # The system turn is repeated wherever it isn't among the new turns.
    in_span = (F.col("system_at") - 1 >= F.col("span.first")) & (F.col("system_at") - 1 <= F.col("span.last"))
    after = (F.col("system_at") == 0) | (F.col("system_at") - 1 < F.col("span.first"))
    kept_system = F.when(~in_span & after, F.col("system")).otherwise(F.slice("system", 1, 0))
    repeated = F.concat(kept_system, history)
    cut = cut.withColumn("repeated", repeated).withColumn("new", F.slice("own", F.col("span.first") + 1, F.col("span.last") - F.col("span.first") + 1))
    cut = cut.withColumn("shown", F.concat("repeated", "new"))
    size = lambda x: F.length(x.head) + F.length(x.body) + len(template.closing)

    def mark(state: Column, x: Column) -> Column:
        begin = state.at + F.length(x.head)
        fresh_target = x.target & (state.k >= F.size("repeated")) & (F.length(x.body) > 0)
        return F.struct(
            (state.k + 1).alias("k"), (state.at + size(x)).cast("long").alias("at"),
            F.when(fresh_target, F.concat(state.spans, F.array(F.struct(begin.cast("long").alias("start"), (begin + F.length(x.body)).cast("long").alias("end"))))).otherwise(
                state.spans).alias("spans"))

    first = F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return cut.select(
        "conv_id", "block", F.col("window").cast("int").alias("window"),
        F.array_join(F.transform("shown", lambda x: F.concat(x.head, x.body, F.lit(template.closing))), "").alias("formatted"),
        F.size("shown").alias("n_turns"), F.size("repeated").alias("n_repeated"),
        F.aggregate("shown", first, mark, lambda s: s.spans).alias("loss_spans"),
        _sum(F.transform("shown", lambda x: x.tokens)).alias("n_tokens"))


def read_windows(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """What the windows say, read back from their text: ``turns``, new turns as structs of role and text, and ``targets``, the texts under the loss mask."""
    turns = template.read(F.col("formatted"))
    return windows.select(
        "*",
        bind(turns, lambda t: F.slice(t, F.col("n_repeated") + 1, F.greatest(F.size(t) - F.col("n_repeated"), F.lit(0)))).alias("turns"),
        F.transform("loss_spans", lambda s: template.unescape(F.substring(F.col("formatted"), (s.start + 1).cast("int"), (s.end - s.start).cast("int")))).alias("targets"))


def conversations_read_back(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """A digest of each conversation from its windows: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows``.

    A digest is over the whole conversation, so its texts meet in one cell.
    """
    read = read_windows(windows, template).select(
        "conv_id", F.struct(
            "block", "window", F.size("turns").alias("n"), F.length("formatted").alias("chars"),
            F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("said"),
            F.array_join("targets", "").alias("loss")).alias("w"))
    whole = read.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return whole.select(
        "conv_id", _sum(F.transform("w", lambda x: x.n.cast("long"))).alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"),
        _sum(F.transform("w", lambda x: x.chars.cast("long"))).alias("formatted_chars"), F.size("w").cast("long").alias("n_windows"))
