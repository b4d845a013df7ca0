"""Language identification: bit-sliced Bloom filters of n-grams, one bit per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common

GRAM = 4
SLOTS = 1 << 20
PROBES = 2
ROWS_PER_LANGUAGE = 10_000  # bound of the labelled sample that the filters are fitted on
LEAST_SHARE = 1e-5  # a language holds the n-grams with at least this share of its text: 100,000 at most

SPACED = common.LOWER.copy()
SPACED[[b for b in range(128) if not chr(b).isalpha()]] = 32


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of four bytes with their rows, in texts that stand between spaces: A-Z lower-cased,
    other ASCII marks as spaces. Those of spaces only are left out."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    gap = GRAM - 1
    spread = np.full(len(data) + gap * len(offsets) + gap, 32, np.uint8)
    spread[np.arange(len(data)) + gap * (row + 1)] = SPACED[data]
    n = len(spread) - gap
    code = np.zeros(n, np.uint32)
    for i in range(GRAM):
        code = (code << np.uint32(8)) | spread[i:i + n]
    begins = offsets[:-1] + gap * np.arange(len(offsets) - 1)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(np.append(begins, n)))
    kept = code != 0x20202020
    return code[kept], of[kept]


def probes(codes: np.ndarray) -> list[np.ndarray]:
    h = common.mix(codes.astype(np.uint64) + common.GOLDEN)
    return [(h >> np.uint64(20 * i)) & np.uint64(SLOTS - 1) for i in range(PROBES)]


@dataclass
class Filters:
    """Slots of language masks (64 languages a word) and the share of false hits of each language."""

    languages: list[str]
    masks: np.ndarray
    false_share: np.ndarray

    def hits(self, codes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each row, and how many of them each language holds: one lookup answers for all languages."""
        total = np.bincount(rows, minlength=n_rows)
        places = probes(codes)
        found = np.zeros((n_rows, len(self.languages)), np.int64)
        for word in range(self.masks.shape[1]):
            mask = self.masks[places[0], word]
            for p in places[1:]:
                mask &= self.masks[p, word]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                held = ((mask >> np.uint64(bit)) & np.uint64(1)).astype(bool)
                found[:, 64 * word + bit] = np.bincount(rows[held], minlength=n_rows)
        return total, found

    def shares(self, total: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Share of a row's n-grams that each language truly holds: hits without the expected false ones."""
        raw = found / np.maximum(total, 1)[:, None]
        return np.clip((raw - self.false_share) / np.maximum(1 - self.false_share, 1e-9), 0, 1)


def fit(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Filters:
    """Filters of the languages of ``labelled`` (doc_id, text, lang). They are fitted on about
    ``rows_per_language`` rows of each language, picked by a hash of doc_id; of a language with
    fewer rows all are used. Rows without text or lang teach nothing."""
    known = labelled.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().toArrow().to_pylist()}
    languages = sorted(counts)
    if not languages:
        return Filters([], np.zeros((SLOTS, 1), np.uint64), np.zeros(0))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / counts[k]))))
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    @common.tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {k: i for i, k in enumerate(languages)}
        keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            language = np.array([number[k] for k in batch.column(1).to_pylist()], np.uint64)
            data, offsets = common.text_bytes(batch.column(0))
            for lo, hi in common.slices(offsets, 1 << 19):
                codes, rows = grams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                new, n = np.unique((language[lo:hi][rows] << np.uint64(32)) | codes, return_counts=True)
                merged, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
                keys, sums = merged, np.bincount(at, np.concatenate((sums, n))).astype(np.int64)
                if len(keys) > 4_000_000:
                    yield tallied(keys, sums)
                    keys, sums = keys[:0], sums[:0]
        yield tallied(keys, sums)

    tally = common.stage(
        picked.select("text", "lang").mapInArrow(count, "lang int, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")
    whole = {r["lang"]: r["n"] for r in tally.groupBy("lang").agg(F.sum("n").alias("n")).toArrow().to_pylist()}
    if not whole:
        return Filters([], np.zeros((SLOTS, 1), np.uint64), np.zeros(0))
    least = F.create_map(*(F.lit(x) for k, n in whole.items() for x in (k, LEAST_SHARE * n)))
    held = tally.filter(F.col("n") >= least[F.col("lang")]).select("lang", "code").toArrow()
    masks = np.zeros((SLOTS, -(-len(languages) // 64)), np.uint64)
    language, codes = held["lang"].to_numpy(), held["code"].to_numpy().astype(np.uint32)
    false_share = np.zeros(len(languages))
    for i in range(len(languages)):
        for p in probes(codes[language == i]):
            masks[p, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        false_share[i] = float(((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) ** PROBES
    return Filters(languages, masks, false_share)


def tallied(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array((keys >> np.uint64(32)).astype(np.int32)), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(sums)],
        ["lang", "code", "n"])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score, coverage of every row of ``docs`` (doc_id, text).

    Every four-byte n-gram of the whole text is looked up once; the slots' masks, taken together,
    name all languages that hold it. The language with the largest share of the n-grams, after its
    expected false hits are taken off, is the prediction (the first by name among equals);
    score is its part of all languages' shares and coverage the share itself. Null texts and those
    without a letter are ``und`` with score 0, as are all texts if nothing was learned. Repeated rows
    are judged alike; other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @common.tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(1))
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in common.slices(offsets, 1 << 19):
                best, score, cover = np.full(hi - lo, -1), np.zeros(hi - lo), np.zeros(hi - lo)
                if model.languages:
                    codes, rows = grams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    shares = model.shares(*model.hits(codes, rows, hi - lo))
                    best = np.where(lettered[lo:hi], shares.argmax(axis=1), -1)
                    cover = np.where(best >= 0, shares.max(axis=1), 0.0)
                    score = cover / np.maximum(shares.sum(axis=1), 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score), pa.array(cover)],
                    ["doc_id", "lang_pred", "score", "coverage"])

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return slim.mapInArrow(judge, "doc_id long, lang_pred string, score double, coverage double")


def held_out(doc_id) -> F.Column:
    """Rows that are kept from learning; false for a null doc_id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_known(docs: DataFrame, filters: Filters, least_coverage: float) -> DataFrame:
    """The documents with a letter whose best language covers at least ``least_coverage`` of the
    text, with all their columns. Judged where they are read; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    place = docs.columns.index("text")

    @common.tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(place))
            keep = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], names=out.fieldNames())
            for lo, hi in common.slices(offsets, 1 << 19):
                if shared.value.languages:
                    codes, rows = grams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    keep[lo:hi] &= shared.value.shares(*shared.value.hits(codes, rows, hi - lo)).max(axis=1) >= least_coverage
                yield own.slice(lo, hi - lo).filter(pa.array(keep[lo:hi]))

    out = docs.schema
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(common.free_name(docs, "lettered"), lettered).mapInArrow(judge, out)
