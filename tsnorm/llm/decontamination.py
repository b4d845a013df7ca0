"""Benchmark decontamination by winnowed fingerprints, joined and extended to exact hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common

PRINTS = "array<struct<gram: string, left: string, right: string, short: boolean, at: array<int>>>"
PRINT_TYPE = pa.list_(pa.struct([
    ("gram", pa.string()), ("left", pa.string()), ("right", pa.string()), ("short", pa.bool_()), ("at", pa.list_(pa.int32()))]))
FILTER_BITS = 1 << 26  # at most 8 MB on each executor; a fuller filter only passes more to the join


def winnow(grams: np.ndarray, counts: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Indices of the grams that are smallest in a window of ``width`` grams of their own row.
    ``counts``: grams of each row; ``first``: index of each row's first gram."""
    selected = np.zeros(len(grams), bool)
    if len(grams) < width:
        return np.flatnonzero(selected)
    least = grams[:len(grams) - width + 1].copy()
    for i in range(1, width):
        np.minimum(least, grams[i:len(grams) - width + 1 + i], out=least)
    whole = np.zeros(len(least) + 1, np.int32)  # windows that lie inside a row
    n = np.maximum(0, counts - width + 1)
    has = n > 0
    np.add.at(whole, first[has], 1)
    np.add.at(whole, (first + n)[has], -1)
    inside = np.cumsum(whole[:-1]) > 0
    for i in range(width):
        selected[i:i + len(least)] |= inside & (grams[i:i + len(least)] == least)
    return np.flatnonzero(selected)


def fingerprints(column: pa.Array, window: int, gram: int, short: list[int] | None, bits: dict[int, np.ndarray] | None):
    """For each text: number of words, and its fingerprints with up to ``window - gram`` words on
    either side (those on the left in reverse). ``short``: sizes of short items whose whole
    sequences count too; None takes a text of fewer than ``window`` words as such an item.
    ``bits`` (by gram size, 0 for the winnowed ones): keeps only hashes that may be in a filter."""
    data, offsets = common.text_bytes(column)
    for lo, hi in common.slices(offsets, 1 << 20):
        part, bounds = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends, first = common.words(part, bounds, common.PLAIN_WORD)
        hashes, n_words = common.word_hashes(part, starts, ends), np.diff(first)
        text = common.LOWER[part].tobytes()
        found: list[dict] = [{} for _ in range(hi - lo)]

        def spell(a: int, b: int, text=text, starts=starts, ends=ends) -> list[str]:
            return [text[starts[i]:ends[i]].decode() for i in range(a, b)]

        def add(at: np.ndarray, k: int, is_short: bool, reach: int, first=first, found=found, spell=spell) -> None:
            for i, r in zip(at.tolist(), (np.searchsorted(first, at, "right") - 1).tolist(), strict=True):
                begin, end = int(first[r]), int(first[r + 1])
                a, b = max(begin, i - reach), min(end, i + k + reach)
                w = spell(a, b)
                key = (" ".join(w[i - a:i - a + k]), " ".join(w[:i - a][::-1]), " ".join(w[i - a + k:]), is_short)
                found[r].setdefault(key, []).append(i - begin)

        grams = common.gram_hashes(hashes, gram)
        picked = winnow(grams, np.maximum(0, n_words - gram + 1), first[:-1], window - gram + 1)
        if bits is not None:
            picked = picked[common.may_hold(bits[0], grams[picked])]
        add(picked, gram, False, window - gram)
        for k in sorted(set(n_words[(n_words > 0) & (n_words < window)].tolist())) if short is None else short:
            grams = common.gram_hashes(hashes, k)
            at = np.arange(len(grams))
            row = np.searchsorted(first, at, "right") - 1
            inside = at + k <= first[row + 1]
            if short is None:
                inside &= n_words[row] == k
            if bits is not None:
                inside &= common.may_hold(bits[k], grams)
            add(at[inside], k, True, 0)
        yield lo, hi, n_words, found


def item_prints(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """Fingerprints of the items: item_id, size (words of the gram, 0 if winnowed), hash, gram, left, right, short."""

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, _, found in fingerprints(batch.column(1), window, gram, None, None):
                ids, keys = [], []
                for r, prints in enumerate(found):
                    ids += [batch.column(0)[lo + r].as_py()] * len(prints)
                    keys += prints
                size = [len(k[0].split(" ")) if k[3] else 0 for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(size, pa.int32()), pa.array([gram_hash(k[0]) for k in keys], pa.int64()),
                     *(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.bool_())))],
                    ["item_id", "size", "hash", "gram", "left", "right", "short"])

    slim = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(scan, "item_id long, size int, hash long, gram string, left string, right string, short boolean")


def gram_hash(gram: str) -> int:
    data, offsets = common.text_bytes(pa.array([gram]))
    starts, ends, _ = common.words(data, offsets, common.PLAIN_WORD)
    return int(common.signed(common.gram_hashes(common.word_hashes(data, starts, ends), len(starts)))[0])


def same_words(mine: Column, theirs: Column) -> Column:
    """Words that two texts have in common from their start on."""
    a, b = (F.filter(F.split(c, " "), lambda w: w != "") for c in (mine, theirs))
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(differ == 0, F.size(a)).otherwise(differ - 1).cast("int")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """Words of documents that lie in any occurrence of ``window`` consecutive words of an item.

    Words are ``[0-9a-z]`` and all characters beyond ASCII, with A-Z lower-cased. Both sides keep the
    grams of ``gram`` words whose hash is the least of ``window - gram + 1`` neighbours, so every
    shared span of ``window`` words shares a kept gram. A bit filter of bounded size over the items' grams,
    which never hides one, drops most others while the documents are read, once. The rest is joined on the gram's
    words and extended over equal words on both sides; hits of fewer than ``window`` words fall
    away. Equal surroundings are joined once, whatever number of documents or items they occur in.
    An item of fewer words, but not none, is one window as a whole.

    Returns one row per document: row (a number), doc_id, n_words, n_hit, spans (sorted [begin, end)
    of hit words, possibly overlapping) and items (ascending ids of the items with hits). Null and
    empty texts have no words and no hits; repeated rows and doc_ids stay apart; null item_ids mark words
    but are not listed. An empty benchmark hits nothing. Other columns are not carried.
    """
    items = common.stage(item_prints(benchmark, window, gram), "item_prints")
    sizes = items.groupBy("size").count().toArrow().to_pylist()  # at most one row per gram size
    bits = {0: np.zeros(1, np.uint64)} | {
        s["size"]: common.bit_filter(items.filter(F.col("size") == s["size"]), "hash", common.filter_size(4 * s["count"], FILTER_BITS))
        for s in sizes}
    short = sorted(s for s in bits if s)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, n_words, found in fingerprints(batch.column(2), window, gram, short, shared.value):
                prints = [[dict(zip(("gram", "left", "right", "short", "at"), (*k, at), strict=True)) for k, at in f.items()] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(n_words.astype(np.int64)), pa.array(prints, PRINT_TYPE)],
                    ["row", "doc_id", "n_words", "prints"])

    slim = docs.select(common.row_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    staged = common.stage(slim.mapInArrow(scan, f"row long, doc_id long, n_words long, prints {PRINTS}"), "prints")
    seen = staged.filter(F.size("prints") > 0).select("row", F.explode("prints").alias("p")).select("row", "p.*")
    key = ["gram", "left", "right", "short"]
    theirs = items.groupBy(*key).agg(F.collect_set("item_id").alias("items")).withColumnsRenamed({"left": "item_left", "right": "item_right"})
    reach = (
        seen.select(*key).distinct().join(theirs, ["gram", "short"])
        .withColumn("l", same_words(F.col("left"), F.col("item_left")))
        .withColumn("r", same_words(F.col("right"), F.col("item_right")))
        .withColumn("n", F.size(F.split("gram", " ")))
        .filter(F.col("short") | (F.col("l") + F.col("n") + F.col("r") >= window))
        .groupBy(*key)
        .agg(F.max("l").alias("l"), F.max(F.col("n") + F.col("r")).alias("r"),
             F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    )
    span = F.transform("at", lambda a: F.struct((a - F.col("l")).alias("begin"), (a + F.col("r")).alias("end")))
    hit = (
        seen.join(reach, key).select("row", span.alias("spans"), "items")
        .groupBy("row")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .withColumn("n_hit", covered(F.col("spans")))
    )
    none = "cast(array() as array<struct<begin: int, end: int>>)"
    return (
        staged.select("row", "doc_id", "n_words").join(hit, "row", "left")
        .select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("spans", F.expr(none)).alias("spans"),
                F.coalesce("items", F.expr("cast(array() as array<long>)")).alias("items"))
    )


def covered(spans: Column) -> Column:
    """Places that sorted spans cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def take(acc: Column, x: Column) -> Column:
        new = F.greatest(F.lit(0), x["end"] - F.greatest(x["begin"], acc["end"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], x["end"]).alias("end"))

    return F.aggregate(spans, start, take, lambda acc: acc["n"])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """The documents without a hit, with all their columns. All rows of a doc_id that is hit go; rows
    without doc_id cannot be told apart and stay. Only rows that may be hit travel."""
    found = common.stage(
        hits(docs, benchmark, window, gram).filter("n_hit > 0 and doc_id is not null").select("doc_id").distinct(), "hit")
    key = F.xxhash64(F.col("doc_id").cast("long"))
    alone, shared = common.divide(docs, key, found.select(F.xxhash64("doc_id").alias("h")))
    return alone.unionByName(shared.join(found, "doc_id", "left_anti").select(docs.columns))
