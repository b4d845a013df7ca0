"""Substring deduplication: content-defined chunks by a gear rolling hash, deduplicated by digest, verified in runs of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common

REACH = 4  # words that a gear hash of 64 bits holds, 16 bits each
BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)  # odd, so they have inverses
RUNS = "doc long, version long, places binary, begins binary, ends binary, digests binary, again boolean, copy boolean"
NO_SPANS = "cast(array() as array<struct<begin: int, end: int>>)"
LAST = 2**63 - 1  # stands for a null doc_id
AS_IS = np.arange(256, dtype=np.uint8)
NAMES = [c.split(" ")[0] for c in RUNS.split(", ")]
FILTER_BITS = 1 << 27  # at most 16 MB on each executor; a fuller filter only passes more to the join
CHUNK_BITS = 1 << 28  # 32 MB for the chunks, which are more


@dataclass(frozen=True)
class Words:
    """Words of a batch of texts: byte ranges, hashes (A-Z as a-z), and the index of each row's first word (and one more)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        starts, ends, first = common.words(data, offsets, common.SPACED_WORD)
        return cls(starts, ends, first, common.word_hashes(data, starts, ends))

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def gear(self) -> np.ndarray:
        """Rolling hash at each word: h = (h << 16) + G[word], begun anew with each row. It holds the last ``REACH`` words."""
        place = np.arange(len(self.hashes)) + REACH * self.row  # rows stand apart, with zeros between
        h = np.zeros(len(self.hashes) + REACH * len(self.first), np.uint64)
        h[place] = common.mix(self.hashes)
        step = 1
        while step < REACH:
            h[step:] += h[:-step] << np.uint64(16 * step)
            step *= 2
        return common.mix(h[place])

    def cuts(self, window: int) -> np.ndarray:
        """Words at which a chunk may begin: the least gear hash of any ``window`` words of a row, the last of equals. They follow the text
        alone, and two of them are at most ``window`` words apart."""
        h, row = self.gear(), self.row
        n = max(0, len(h) - window + 1)
        least, at = h[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window):
            better = h[j:j + n] <= least
            np.copyto(least, h[j:j + n], where=better)
            at[better] = j
        whole = row[:n] == row[window - 1:]  # the window lies in one row
        return np.unique((np.arange(n) + at)[whole])

    def chunks(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and ends of the chunks: from each cut to the first one ``window`` words on, less than twice that."""
        cuts, row = self.cuts(window), self.row
        end = np.searchsorted(cuts, cuts + window)
        there = end < len(cuts)
        cuts, ends = cuts[there], cuts[end[there]]
        same = row[cuts] == row[ends]
        return cuts[same], ends[same]

    def exact(self, data: np.ndarray, rows: np.ndarray, runs: np.ndarray, length: int) -> np.ndarray:
        """128-bit digests of runs of ``length`` words, byte for byte: of all words with the white space after them, but the last one
        without. Only words of ``rows`` (where the runs lie) are hashed for that."""
        used = np.zeros(len(self.first) - 1, bool)
        used[rows] = True
        used = np.repeat(used, np.diff(self.first))
        at = np.cumsum(used) - 1
        starts, ends = self.starts[used], self.ends[used]
        follow = np.append(starts[1:], ends[-1:])
        last = np.append(np.flatnonzero(np.diff(self.row[used])), len(starts) - 1)
        follow[last] = ends[last]
        bare = common.word_hashes(data, starts, ends, AS_IS)
        spaced = common.word_hashes(data, starts, follow, AS_IS)
        out = []
        for base in BASES:
            salt = np.uint64(base)
            final = common.mix(bare[at[runs + length - 1]] + salt) * np.uint64(pow(base, length, 1 << 64))
            out.append(common.mix(Digests(common.mix(spaced + salt), base).of(at[runs], at[runs + length - 1]) + final))
        return np.stack(out, axis=1)


class Digests:
    """Hashes of any runs of words, from running sums of hash * base^place, which are shifted to place 0."""

    def __init__(self, hashes: np.ndarray, base: int = BASES[0]):
        n = len(hashes) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(hashes * powers(base, n)[:-1], out=self.sums[1:])
        self.shift = powers(pow(base, -1, 1 << 64), n)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        run = (self.sums[end] - self.sums[begin]) * self.shift[begin]
        return common.mix(run + (end - begin).astype(np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def keyed(docs: DataFrame) -> list[Column]:
    """doc and version: doc_id with null as the last one, and a hash of the text. They name a
    row by its content, so the same rows are found again in any later scan."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("version")]


def chunk_window(min_words: int) -> int:
    """Window of the cutter for which every run of ``min_words`` words holds a whole chunk, wherever it stands: the gear hash knows
    only words of the run from its ``REACH``-th word on, a cut follows within a window, and its chunk ends within two more."""
    return max(1, (min_words - REACH + 2) // 3)


def first_of_copies(texts: DataFrame) -> DataFrame:
    """Documents with the least doc of all whose text is the same, staged: doc, version. One slim row a document is shuffled."""
    same = texts.groupBy("version", F.xxhash64("text", F.lit(1)).alias("other")).agg(F.min("doc").alias("doc"))
    return common.stage(same.select(F.xxhash64("doc", "version").alias("h")), "firsts")


def chunks_seen_twice(texts: DataFrame, min_words: int, firsts) -> DataFrame:
    """Digests of the chunks that stand at two places or more, staged. Further copies of a text are not looked at."""
    window = chunk_window(min_words)

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(common.may_hold(firsts.value, batch.column("h").to_numpy().view(np.uint64))))
            data, offsets = common.text_bytes(batch.column("text"))
            for lo, hi in common.slices(offsets, 1 << 20):
                words = Words.of(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                found, n = np.unique(Digests(words.hashes).of(*words.chunks(window)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(common.signed(found)), pa.array(n.astype(np.int64))], ["chunk", "n"])

    counts = texts.select("h", "text").mapInArrow(scan, "chunk long, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    return common.stage(counts.filter("n > 1").select("chunk"), "chunks")


def candidates(texts: DataFrame, bits, firsts, min_words: int) -> DataFrame:
    """One row per document with runs of ``min_words`` words that hold a chunk which may be in the filter: the runs' places (in
    words), byte ranges and 128-bit digests, and whether a digest occurs again in it; staged. A further copy of an earlier text has
    one run, its whole text, and ``copy`` is set; ``places`` has its number of words."""
    window = chunk_window(min_words)

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = common.may_hold(firsts.value, batch.column("h").to_numpy().view(np.uint64))
            data, offsets = common.text_bytes(batch.column("text"))
            for lo, hi in common.slices(offsets, 1 << 20):
                bounds = offsets[lo:hi + 1] - offsets[lo]
                part = data[offsets[lo]:offsets[hi]]
                words = Words.of(part, bounds)
                n, row_of = len(words.hashes), words.row
                begin, end = words.chunks(window)
                seen = common.may_hold(bits.value, Digests(words.hashes).of(begin, end)) & first[lo:hi][row_of[begin]]
                # runs from end - min_words to begin hold the chunk
                mark = np.zeros(n + 1, np.int64)
                np.add.at(mark, np.maximum(end[seen] - min_words, words.first[row_of[begin[seen]]]), 1)
                np.add.at(mark, begin[seen] + 1, -1)
                left = words.first[1:][row_of] - np.arange(n)  # words to the end of the row
                runs = np.flatnonzero((np.cumsum(mark[:-1]) > 0) & (left >= min_words))
                edges = np.searchsorted(runs, words.first)
                rows = np.flatnonzero(np.diff(edges))
                edges = np.append(edges[rows], len(runs))
                both = words.exact(part, rows, runs, min_words) if len(runs) else np.zeros((0, 2), np.uint64)
                again = [len(np.unique(both[a:b, 0])) < b - a for a, b in zip(edges[:-1], edges[1:], strict=True)]
                row, at = np.repeat(rows, np.diff(edges)), pa.array(lo + rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(at), batch.column("version").take(at), common.binary((runs - words.first[row]).astype(np.int32), edges),
                     common.binary((words.starts[runs] - bounds[row]).astype(np.int32), edges),
                     common.binary((words.ends[runs + min_words - 1] - bounds[row]).astype(np.int32), edges),
                     common.binary(both.view(np.dtype("V16")).ravel(), edges), pa.array(again, pa.bool_()), pa.array(np.zeros(len(rows), bool))], NAMES)
                rows = np.flatnonzero(~first[lo:hi] & (np.diff(words.first) >= min_words))
                one, at = np.arange(len(rows) + 1), pa.array(lo + rows)
                none = common.binary(np.zeros(0, np.dtype("V16")), np.zeros(len(rows) + 1, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(at), batch.column("version").take(at), common.binary(np.diff(words.first)[rows].astype(np.int32), one),
                     common.binary((words.starts[words.first[rows]] - bounds[rows]).astype(np.int32), one),
                     common.binary((words.ends[words.first[rows + 1] - 1] - bounds[rows]).astype(np.int32), one),
                     none, pa.array(np.zeros(len(rows), bool)), pa.array(np.ones(len(rows), bool))], NAMES)

    return common.stage(texts.mapInArrow(scan, RUNS), "runs")


def occurrences(staged: DataFrame) -> DataFrame:
    """Runs of every document, each digest once: doc, version, hi, lo."""

    @common.tidy
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2).cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            both = np.frombuffer(column.buffers()[2] or b"", np.uint64)[ends[0] // 8:ends[-1] // 8].reshape(-1, 2)
            row = np.repeat(np.arange(len(batch)), np.diff(ends) // 16)
            order = np.lexsort((both[:, 1], both[:, 0], row))
            both, row = both[order], row[order]
            once = np.ones(len(row), bool)
            once[1:] = (row[1:] != row[:-1]) | (both[1:] != both[:-1]).any(axis=1)
            both, at = both[once], pa.array(row[once])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(common.signed(np.ascontiguousarray(both[:, 0]))), pa.array(common.signed(np.ascontiguousarray(both[:, 1])))],
                ["doc", "version", "hi", "lo"])

    return staged.select("doc", "version", "digests").mapInArrow(spread, "doc long, version long, hi long, lo long")


def repeated(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """Passages that stand in another document of smaller doc_id, or earlier in the same one: doc,
    version (see ``keyed``), spans (array of [begin, end) in UTF-8 bytes), words. Staged; only
    documents with such passages have a row, equal rows share one.

    A word is repeated if it lies in a run of ``min_words`` words that stands at such a place byte for byte, capitals and white space
    between the words included (within one document, at one that does not overlap it). A gear hash over words cuts texts into chunks that follow the
    content alone, so every run holds a whole one, the same wherever it stands. Chunks are deduplicated by digest; those
    that stand at one place only cannot lie in a repeated run, and a bit filter of bounded size over all others picks the runs
    that are candidates. Their digests (128 bits) are counted with their least doc_id before the shuffle, and those seen
    twice are joined exactly. So no repeated run is missed, and none is taken whose words stand nowhere else. Of equal texts
    the first one alone is looked through; further copies are one passage from the first word to the last.
    """
    texts = docs.select(*keyed(docs), F.col("text").cast("string").alias("text"))
    texts = texts.select(F.xxhash64("doc", "version").alias("h"), "doc", "version", "text")
    send = docs.sparkSession.sparkContext.broadcast

    def filter_of(table: DataFrame, most: int):
        return send(common.bit_filter(table, table.columns[0], common.filter_size(table.count(), most)))

    firsts = filter_of(first_of_copies(texts), FILTER_BITS)
    bits = filter_of(chunks_seen_twice(texts, min_words, firsts), CHUNK_BITS)
    everything = candidates(texts, bits, firsts, min_words)
    staged = everything.filter("not copy")
    owners = common.stage(
        occurrences(staged).groupBy("hi", "lo").agg(F.min("doc").alias("owner"), F.count("doc").alias("n"))
        .filter("n > 1").select("hi", "lo", "owner"), "owners")
    known = common.stage(
        occurrences(staged).join(owners, ["hi", "lo"]).filter(F.col("doc") > F.col("owner"))
        .groupBy("doc", "version").agg(F.collect_list("hi").alias("hi")), "known")
    key = F.xxhash64("doc", "version")
    alone, shared = common.divide(staged, key, known.select(key.alias("h")), FILTER_BITS)

    @common.tidy
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans, words = [], [], []
            for i in range(len(batch)):
                found = passages(*(batch.column(c)[i].as_buffer() for c in ("places", "begins", "ends", "digests")),
                                 batch.column("hi")[i].values, min_words)
                if found:
                    at.append(i)
                    spans.append([{"begin": a, "end": b} for a, b, _ in found])
                    words.append(sum(x[2] for x in found))
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(at, pa.int64())), batch.column("version").take(pa.array(at, pa.int64())),
                 pa.array(spans, kind), pa.array(words, pa.int64())], ["doc", "version", "spans", "words"])

    @common.tidy
    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, begin, end = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32) for c in ("places", "begins", "ends"))
            spans = [[{"begin": a, "end": b}] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("version"), pa.array(spans, kind), pa.array(n.astype(np.int64))], ["doc", "version", "spans", "words"])

    both = alone.filter("again").withColumn("hi", F.expr("cast(null as array<long>)")).unionByName(
        shared.join(known, ["doc", "version"], "left").filter(F.col("again") | F.col("hi").isNotNull()))
    told = "doc long, version long, spans array<struct<begin: int, end: int>>, words long"
    found = both.select("doc", "version", "places", "begins", "ends", "digests", "hi").mapInArrow(runs, told).unionByName(
        everything.filter("copy").select("doc", "version", "places", "begins", "ends").mapInArrow(copies, told))
    return common.stage(found.dropDuplicates(["doc", "version"]), "spans")


def passages(places, begins, ends, digests, known, min_words: int) -> list[tuple[int, int, int]]:
    """Passages of one document, which are repeated runs that overlap: begin, end, words."""
    both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    places, begins, ends = (np.frombuffer(x, np.int32) for x in (places, begins, ends))
    _, first, same = np.unique(both[:, 0] ^ common.mix(both[:, 1]), return_index=True, return_inverse=True)
    again = places - places[first[same]] >= min_words
    if known is not None and len(known):
        again |= np.isin(both[:, 0], known.to_numpy(zero_copy_only=False).view(np.uint64))
    places, begins, ends = places[again], begins[again], ends[again]
    if len(places) == 0:
        return []
    edge = np.flatnonzero(np.diff(places) >= min_words)
    return [
        (int(begins[a]), int(ends[b]), int(places[b] - places[a]) + min_words)
        for a, b in zip(np.append(0, edge + 1), np.append(edge, len(places) - 1), strict=True)
    ]


def cut_spans(text: Column, spans: Column) -> Column:
    """Text without byte ranges. Ranges begin and end at words, so no character is split."""
    raw = F.encode(text, "UTF-8")
    parts = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"])),
        F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.octet_length(text))),
        lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    return F.array_join(parts, "")


def dedup_substrings(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """All documents, their repeated passages cut out of ``text``; adds ``removed_spans`` (byte ranges
    in the former text; empty if none) and ``removed_words``.

    The first document by doc_id keeps a passage; within one document the first place does. Rows
    that share a doc_id count as one document and keep each other's passages, and so do those
    whose doc_id is null, after all others. Null texts stay null, empty ones empty, and a text without
    white space is one word. Columns of the input named like those added are replaced; all others stay.
    """
    found = repeated(docs, min_words)
    # only documents with passages travel to the join
    alone, shared = common.divide(
        docs.drop("removed_spans", "removed_words"), F.xxhash64(*keyed(docs)), found.select(F.xxhash64("doc", "version").alias("h")), FILTER_BITS)
    none = {"removed_spans": F.expr(NO_SPANS), "removed_words": F.lit(0).cast("long")}
    doc, version, text, spans, words = (common.free_name(docs, c) for c in ("doc", "version", "whole", "spans", "words"))
    found = found.toDF(doc, version, spans, words)
    cut = (
        shared.withColumns(dict(zip((doc, version), keyed(docs), strict=True))).withColumnRenamed("text", text)
        .join(found, [doc, version], "left")
        .withColumns({
            "text": F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut_spans(F.col(text), F.col(spans))),
            "removed_spans": F.coalesce(spans, none["removed_spans"]), "removed_words": F.coalesce(words, none["removed_words"])})
    )
    out = [*docs.drop("removed_spans", "removed_words").columns, *none]
    return alone.withColumns(none).select(out).unionByName(cut.select(out))
