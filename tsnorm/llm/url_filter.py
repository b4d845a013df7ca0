"""URL verdicts: rules first, else words of host and path, found by Viterbi and weighed by naive Bayes."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common

VOCABULARY = 100_000  # words of the unigram model, the most frequent ones: bound of its size
FEATURES = 1 << 18  # tokens are hashed to so many features: bound of the Bayes model
LONGEST_WORD = 24
RUN = re.compile(r"[^\W\d_]+|\d+")


def upper_to_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return upper_to_lower(host), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest rule that fits, and its verdict; null if none does. A rule is a host, then a path
    from its slash on; it fits the host and its subdomains where the path begins with the rule's.
    Rules are a short list that the caller names, so they are conditions of the plan."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, value in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own = rule.partition("/")[0]
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(rule[len(own):]))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, value).otherwise(verdict)
    return name, verdict


@dataclass
class Words:
    """Unigram model: splits names into the most likely words."""

    costs: dict[str, float]
    total: int
    known: dict[str, list[str]] = field(default_factory=dict)

    def cost(self, word: str) -> float:
        """Negative log probability; unknown words get rarer with every letter."""
        found = self.costs.get(word)
        return found if found is not None else math.log(self.total + 1) + len(word) * math.log(10) - math.log(10)

    def split(self, name: str) -> list[str]:
        found = self.known.get(name)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()  # saves time only
            found = self.known[name] = self.viterbi(name)
        return found

    def viterbi(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            cost, begin = min((best[a] + self.cost(name[a:end]), a) for a in range(max(0, end - LONGEST_WORD), end))
            best.append(cost)
            back.append(begin)
        out, end = [], len(name)
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        return out[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        out = []
        for kind, text in (("h", host), ("p", path.lower())):
            for run in RUN.findall(text):
                out += [f"{kind} #{len(run)}"] if run[0].isdigit() else [f"{kind} {w}" for w in self.split(run)]
        return out


def fit_words(html: DataFrame) -> Words:
    """Unigram counts of the words of all pages (column html): runs of letters outside tags, scripts and
    styles, lower-cased. Counted before the shuffle; the most frequent ``VOCABULARY`` make the model."""
    text = F.lower(F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&[a-z]+;", " "))
    counts = (
        html.select(F.explode(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"))).alias("word"))
        .groupBy("word").agg(F.count("word").alias("n")))
    counts = common.stage(counts, "words")
    total = counts.agg(F.sum("n").alias("n")).toArrow()["n"][0].as_py() or 0
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY).toArrow()
    costs = np.log(total or 1) - np.log(top["n"].to_numpy()) if len(top) else []
    return Words(dict(zip(top["word"].to_pylist(), [float(c) for c in costs], strict=True)), total)


@dataclass
class Bayes:
    """Log odds of blocking: of the prior and of each feature."""

    prior: float
    weights: np.ndarray

    def blocks(self, tokens: list[str]) -> float:
        return self.prior + float(self.weights[features(tokens)].sum()) if tokens else self.prior


def features(tokens: list[str]) -> list[int]:
    return [zlib.crc32(t.encode()) % FEATURES for t in tokens]


def fit_bayes(labelled: DataFrame, words: Words) -> Bayes:
    """Multinomial naive Bayes (add-one) over host, path, verdict. With no row of either verdict the
    other one always wins, and ``allow`` if there are none at all."""
    shared = labelled.sparkSession.sparkContext.broadcast(words)

    @common.tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, pages = np.zeros((2, FEATURES), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = int(verdict == "block")
                pages[kind] += 1
                np.add.at(sums[kind], features(shared.value.tokens(host, path)), 1)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), *(pa.array(np.append(sums[i, at], pages[i])) for i in (0, 1))], ["feature", "allow", "block"])

    rows = (
        labelled.select("host", "path", "verdict").mapInArrow(count, "feature long, allow long, block long")
        .groupBy("feature").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).toArrow().to_pylist())
    sums, pages = np.zeros((2, FEATURES)), np.zeros(2)
    for r in rows:
        if r["feature"] < 0:
            pages = np.array([r["allow"], r["block"]], float)
        else:
            sums[:, r["feature"]] = r["allow"], r["block"]
    if pages.min() == 0:
        return Bayes(math.inf if pages[1] > 0 else -math.inf, np.zeros(FEATURES))
    odds = np.log((sums + 1) / (sums.sum(axis=1, keepdims=True) + FEATURES))
    return Bayes(float(np.log(pages[1] / pages[0])), odds[1] - odds[0])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page (page_id, url, html).

    The longest rule that fits decides. All other pages are judged by a naive Bayes model over the
    words of host and path, which learns from the pages that rules decide; names that were run together are
    split by Viterbi over the unigram words of all pages' text. score is the log odds of
    blocking. Null urls and those without ``://`` have an empty host and path, and the prior decides. Repeated rows
    are judged alike; rows of a null page_id are judged too; other columns are not carried.
    """
    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = cut.withColumns({"rule": rule, "verdict": verdict})
    words = fit_words(pages.select("html"))
    model = fit_bayes(ruled.filter("verdict is not null"), words)
    shared = pages.sparkSession.sparkContext.broadcast((words, model))

    @common.tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shared.value
        for batch in batches:
            scores = [model.blocks(words.tokens(h, p)) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            verdicts = [v or ("block" if s > 0 else "allow") for v, s in zip(batch.column(4).to_pylist(), scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                ["page_id", "host", "path", "rule", "verdict", "score"])

    return ruled.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, score double")
