"""Records with quoted line breaks in files that are read in splits.

A split begins somewhere in its file, perhaps inside a quoted cell. Whether it does follows from what the splits before
it do to an open quote: each of them, and each line, leaves the state as it is, turns it, or sets it, whatever it was. Such
effects are summed up by running counts, first over the lines of a split, then over the splits of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

QUOTE = '"'


def ends_inside(line: Column, inside: Column, sep: str) -> Column:
    """Whether a quoted cell is open after a line that begins ``inside`` one (or not).

    A quote opens a cell at its beginning only, and any quote but a doubled one closes it.
    """
    single = F.replace(line, F.lit(QUOTE * 2), F.lit(""))
    parts = F.split(F.concat(F.lit(sep), single), QUOTE)
    begins = rf"\Q{sep}\E[\x00-\x20]*$"
    followed = F.slice(parts, F.lit(1), F.size(parts) - 1)
    state = F.aggregate(followed, inside, lambda s, part: ~s & F.rlike(part, F.lit(begins)))
    return F.when(F.contains(line, F.lit(QUOTE)), state).otherwise(inside)


def first_record(lines: Column, sep: str) -> Column:
    """The lines of the first record, joined, from the first lines of a file."""
    if len(sep) > 1:
        return F.get(lines, F.lit(0))
    start = F.struct(F.lit(None).cast("string").alias("text"), F.lit(True).alias("open"))
    return F.aggregate(
        lines, start,
        lambda a, line: F.when(a["open"], F.struct(
            F.concat_ws("\n", a["text"], line).alias("text"), ends_inside(line, a["text"].isNotNull(), sep).alias("open"))).otherwise(a),
        lambda a: a["text"])


def with_state(rows: DataFrame, by: WindowSpec, start: Column) -> DataFrame:
    """Adds ``inside``, 1 where a row begins inside a quoted cell; ``start`` is the state before the first.

    It is what the last row that sets the state left, turned as often as the rows after that do.
    """
    outside, inside = F.col("from_outside"), F.col("from_inside")
    turn = (outside & ~inside).cast("int")
    turns = F.sum(turn).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_before", turns - turn).withColumn("_base", F.when(outside == inside, outside.cast("int") - turns))
    last = F.last("_base", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("inside", F.pmod(F.coalesce(last, start) + F.col("_before"), F.lit(2))).drop("_base", "_before")


def effects(lines: DataFrame, sep: str) -> DataFrame:
    line = F.col("line")
    return lines.withColumns({"from_outside": ends_inside(line, F.lit(False), sep), "from_inside": ends_inside(line, F.lit(True), sep)})


def broken_splits(lines: DataFrame, sep: str) -> DataFrame:
    """Splits in which a line ends inside a quoted cell: ``source_file, block, start, owner`` (start 1: the split begins in
    one; owner: the last split before it in which a record begins).

    ``lines`` has ``source_file, block, row, line``, all lines of the files. One pass over them leaves a row for each split,
    with the effects of its lines that hold a quote.
    """
    quoted = F.contains(F.col("line"), F.lit(QUOTE))
    mark = F.when(quoted, F.struct("row", "from_outside", "from_inside"))
    splits = effects(lines, sep).groupBy("source_file", "block").agg(
        F.sort_array(F.collect_list(mark)).alias("marks"), F.max("row").alias("last"))

    def through(inside: bool) -> Column:
        start = F.struct(F.lit(inside).alias("open"), F.lit(inside).alias("broken"), F.lit(not inside).alias("begun"))

        def step(a: Column, m: Column) -> Column:
            after = F.when(a["open"], m["from_inside"]).otherwise(m["from_outside"])
            begun = a["begun"] | (~after & (m["row"] < F.col("last")))
            return F.struct(after.alias("open"), (a["broken"] | after).alias("broken"), begun.alias("begun"))

        return F.aggregate("marks", start, step)

    splits = splits.select("source_file", "block", through(False).alias("a"), through(True).alias("b")).select(
        "source_file", "block", F.col("a.open").alias("from_outside"), F.col("b.open").alias("from_inside"),
        F.col("a.broken").alias("broken"), F.col("b.begun").alias("begun"))
    # one row a split
    by = Window.partitionBy("source_file").orderBy("block")
    splits = with_state(splits, by, F.lit(0))
    begins = F.when((F.col("inside") == 0) | F.col("begun"), F.col("block"))
    owner = F.last(begins, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return splits.withColumn("owner", owner).where("broken or inside = 1").select(
        "source_file", "block", F.col("inside").alias("start"), "owner")


def whole_records(lines: DataFrame, broken: DataFrame, sep: str, header: bool) -> DataFrame:
    """Records of the broken splits: ``source_file, block, row, line``, with line breaks in ``line``.

    Only these splits are shuffled, once, each to one task. A record belongs to the split it begins in; of a split only the first and the
    last piece are shuffled again, to be joined to those of other splits. With ``header`` the first record of each file is left out.
    """
    at = Window.partitionBy("source_file", "block").orderBy("row")
    rows = effects(lines.join(broken.select("source_file", "block", "start"), ["source_file", "block"]), sep)
    rows = with_state(rows, at, F.col("start"))
    begun = F.sum(1 - F.col("inside")).over(at.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pieces = rows.withColumn("record", begun).groupBy("source_file", "block", "record").agg(
        F.min("row").alias("row"), F.sort_array(F.collect_list(F.struct("row", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    split = Window.partitionBy("source_file", "block")
    pieces = pieces.select("source_file", "block", "record", "row", text.alias("line")).withColumn("last", F.max("record").over(split))
    if header:
        first = F.min(F.when((F.col("block") == 0) & (F.trim("line") != ""), F.col("record"))).over(split)
        pieces = pieces.withColumn("left_out", F.coalesce(F.col("record") == first, F.lit(False)))
    else:
        pieces = pieces.withColumn("left_out", F.lit(False))

    inner = pieces.where("record > 0 and record < last").select("source_file", "block", "row", "line", "left_out")
    # both branches shuffle the same lines, so that is done once: owners are joined after it
    owners = broken.select("source_file", "block", "owner")
    edge = pieces.where("record = 0 or record = last").join(owners, ["source_file", "block"]).withColumn(
        "key", F.when(F.col("record") > 0, F.col("block")).otherwise(F.col("owner"))).where("key is not null")
    edge = edge.groupBy("source_file", "key").agg(
        F.min_by("row", "block").alias("row"), F.sort_array(F.collect_list(F.struct("block", "line"))).alias("lines"),
        F.max("left_out").alias("left_out"))
    edge = edge.select("source_file", F.col("key").alias("block"), "row", text.alias("line"), "left_out")
    out = inner.unionByName(edge).where((F.trim("line") != "") & ~F.col("left_out"))
    return out.select("source_file", "block", "row", "line")
