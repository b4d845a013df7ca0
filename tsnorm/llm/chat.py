"""Chat formatting: windows of whole turns within a token budget, with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tsnorm.llm import common

OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    """Backslash and ``<`` become letters behind a backslash, so no mark can stand in a text."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def formatted_turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """What a turn begins with, its text and the mark behind it, as they stand in a window."""
    return F.concat(F.lit(OPEN), escape_role(role), F.lit("\n")), escape(text), F.lit(CLOSE)


def most_tokens(role: Column, text: Column) -> Column:
    """UTF-8 bytes of a formatted turn: no tokenizer that falls back on bytes, or knows longer strings only, makes more ids of it."""
    return F.octet_length(F.concat(*formatted_turn(role, text))).cast("long")


def numbered(rows: DataFrame, budget: int, history: int, tokens: str | None = None) -> DataFrame:
    """Turns with rank (place in the conversation), before (tokens of its turns before) and span.

    Prefix sums are taken in two levels: turns are dealt by ranges of (conversation, turn), summed
    within a task's part of a conversation, and the parts' totals are summed up. So a conversation with
    a third of all turns is spread over many tasks. Span boundaries follow from the sums alone: a
    span holds the turns that begin and end within one stretch of ``budget - history - system`` tokens;
    a turn that crosses the end of a stretch is a span of its own.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    given = F.lit(None).cast("long") if tokens is None else F.col(tokens).cast("long")
    turns = rows.select(
        key.alias("key"), "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        common.row_id().alias("row"), given.alias("tokens"))
    turns = turns.withColumns({"tokens": F.coalesce("tokens", most_tokens(F.col("role"), F.col("text"))), "tie": F.xxhash64("text")})
    order = ["turn", "role", "tie", "row"]
    dealt = common.stage(
        turns.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id()), "turns")
    by_part = Window.partitionBy("key").orderBy("part")
    parts = (
        dealt.groupBy("key", "part")
        .agg(F.count("row").alias("n"), F.sum("tokens").alias("t"),
             F.min_by(F.struct("role", "tokens"), F.struct(*order)).alias("first"))
        .select(
            "key", "part",
            (F.sum("n").over(by_part) - F.col("n")).alias("n_before"), (F.sum("t").over(by_part) - F.col("t")).alias("t_before"),
            F.first("first").over(by_part).alias("first"))
        .select("key", "part", "n_before", "t_before",
                F.when(F.col("first.role") == "system", F.col("first.tokens")).otherwise(0).cast("long").alias("system_tokens"))
    )
    own = Window.partitionBy("key", "part").orderBy(*order)
    stretch = F.greatest(F.lit(1), budget - history - F.col("system_tokens"))
    place = F.col("before") - F.col("system_tokens")
    crosses = (place % stretch > 0) & (place % stretch + F.col("tokens") > stretch)
    out = (
        dealt.withColumns({"rank": F.row_number().over(own) - 1, "sum": F.sum("tokens").over(own) - F.col("tokens")})
        .join(parts, ["key", "part"])
        .withColumns({"rank": F.col("n_before") + F.col("rank"), "before": F.col("t_before") + F.col("sum")})
        .withColumn("system", (F.col("rank") == 0) & (F.col("system_tokens") > 0))
        .withColumn("span", F.when(F.col("system"), 0).otherwise(2 * F.floor(place / stretch) + crosses.cast("long")).cast("long"))
    )
    return common.stage(
        out.select("key", "conv_id", "rank", "before", "tokens", "system", "span", "role", "text"), "numbered")


def windows(rows: DataFrame, budget: int = 4096, history: int = 1024, history_turns: int = 2, tokens: str | None = None) -> DataFrame:
    """Training windows of conversations (conv_id, turn, role, text), turns in the order of turn.

    A window holds the system turn (a first turn of that role), up to ``history_turns`` turns before
    its own with at most ``history`` tokens in all, and the turns of its span, so at most ``budget``
    tokens unless a single turn or the system turn is longer than its part. A turn counts as many tokens as it has UTF-8 bytes once it is
    formatted, marks included, which is never too few; ``tokens`` names a column with smaller counts, such as those of a
    tokenizer (of the formatted turn; null: bytes). The loss mask covers the text of each
    assistant turn in the one window whose span it is in; repeated turns have none.

    Columns: conv_id, window (ascending in the conversation), n_context (repeated turns at its begin),
    n_turns (its own), tokens, text, loss (begin and length in code points, in order). Each turn is
    marked, ``<turn>role`` line feed ``text</turn>`` line feed, with texts and roles escaped. Null texts and roles are
    empty; turns with equal numbers are ordered by role and text, repeated rows are repeated turns; rows
    of a null conv_id are one conversation; null turns come first. Other columns are not carried.
    """
    turns = numbered(rows, budget, history, tokens)
    body = turns.filter(~F.col("system"))
    spans = body.groupBy("key", "span").agg(F.min("rank").alias("first"), F.min("before").alias("start"))
    columns = ["key", "conv_id", "span", "rank", "tokens", "own", "role", "text"]
    new = turns.withColumn("own", F.lit(True)).select(columns)
    past = (
        body.drop("span").withColumn("first", F.explode(F.sequence(F.col("rank") + 1, F.col("rank") + history_turns)))
        .join(spans, ["key", "first"]).filter(F.col("start") - F.col("before") <= history)
        .withColumn("own", F.lit(False)).select(columns)
    ) if history_turns else None
    system = (
        turns.filter("system").drop("span").join(spans.filter("span > 0").select("key", "span"), "key")
        .withColumn("own", F.lit(False)).select(columns))
    every = new.unionByName(system) if past is None else new.unionByName(system).unionByName(past)
    head, told, close = formatted_turn(F.col("role"), F.col("text"))
    piece = F.struct(
        "rank", "own", "tokens", F.concat(head, told, close).alias("piece"),
        F.length(head).alias("begin"), F.length(told).alias("length"), (F.col("own") & (F.col("role") == "assistant")).alias("loss"))
    pieces = every.select("key", "conv_id", "span", piece.alias("p")).groupBy("key", "span").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list("p")).alias("p"))
    mask = F.aggregate(
        "p", F.expr("named_struct('at', 0, 'loss', cast(array() as array<struct<begin: int, length: int>>))"),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["loss"], F.concat(acc["loss"], F.array(F.struct((acc["at"] + x["begin"]).alias("begin"), x["length"].alias("length")))))
            .otherwise(acc["loss"]).alias("loss")),
        lambda acc: acc["loss"])
    return pieces.select(
        "conv_id", F.col("span").alias("window"),
        F.size(F.filter("p", lambda x: ~x["own"])).alias("n_context"), F.size(F.filter("p", lambda x: x["own"])).alias("n_turns"),
        F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"),
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"), mask.alias("loss"))


def parsed(text: Column) -> Column:
    """Turns of a formatted text: array of role and text, unescaped."""
    parts = F.filter(F.split(text, CLOSE), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(
        unescape_role(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, "\n") + 1)).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """What each window adds, read from its formatted text: conv_id, window, turns (array of role and
    text, without the repeated ones), target (text under the loss mask, unescaped), chars."""
    turns = parsed(F.col("text"))
    target = F.array_join(
        F.transform("loss", lambda x: unescape(F.substr(F.col("text"), x["begin"] + 1, x["length"]))), "")
    return formatted.select(
        "conv_id", "window", F.slice(turns, F.col("n_context") + 1, F.greatest(F.col("n_turns"), F.lit(0))).alias("turns"),
        target.alias("target"), F.length("text").alias("chars"))
