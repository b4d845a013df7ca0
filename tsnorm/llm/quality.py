"""Quality rules as a ledger of bits: every rule is evaluated once, policies and ablations read the bits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8  # words of a window that may be repeated
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``failed`` makes a condition of the measures; it must not be null. ``bit`` (0 to 62) is the rule's for good."""

    bit: int
    name: str
    failed: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A version of what is asked of a document: the names of the rules it must not fail."""

    version: int
    rules: tuple[str, ...]


RULES = [
    Rule(0, "few_words", lambda: F.col("n_words") < 20),
    Rule(1, "repeated_words", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule(2, "many_symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule(3, "repeated_lines", lambda: 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
    Rule(4, "short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule(5, "long_words", lambda: F.col("word_chars") > 20 * F.col("n_words")),
]
POLICIES = [
    Policy(1, ("few_words", "repeated_words")),
    Policy(2, ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words")),
]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often and however deep in lambdas it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words which stands twice or more in the array, first places included.

    Windows have a hash each; where all differ, as in most texts, nothing is repeated. Else they are sorted by hash
    with their place, so equal ones are neighbours, and neighbours of one hash are compared word by
    word. The time is that of a sort, whatever is repeated how often.
    """

    def windows(hashes: Column) -> Column:
        every = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))
        return F.slice(every, F.lit(1), F.size(hashes) - (WINDOW - 1))

    def same(a: Column, b: Column) -> Column:
        texts = F.slice(words, a["at"], WINDOW) == F.slice(words, b["at"], WINDOW)
        return F.when(a["h"] == b["h"], texts).otherwise(F.lit(False))

    def places(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
        return F.array_sort(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n"), (i + WINDOW).alias("end")),
            lambda a: a["n"])

    def count(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), bound(bound(ordered, places), covered)).otherwise(none)

    none = F.lit(0).cast("long")
    return F.when(F.size(words) > WINDOW, bound(bound(F.transform(words, lambda w: F.xxhash64(w)), windows), count)).otherwise(none)


def measures(text: Column) -> Column:
    """All measures of a text as one struct of longs; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    n_chars = (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long")
    of_words = bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    of_lines = bound(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return bound(F.struct(of_words.alias("w"), of_lines.alias("l")), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"), n_chars.alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"), m["l"]["n_lines"].alias("n_lines"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"), m["w"]["n_repeat_words"].alias("n_repeat_words")))


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    """The bits of all rules that a row of measures fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.failed(), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """One row for every document: doc_id, the columns ``by``, the measures and ``failed``, the bits of the rules
    it fails; staged, so texts are read once, whatever policies come later.

    Null texts are empty: no word, no line. Words are runs of what is not ASCII white space, in whole texts;
    lines are split at line feeds and count if they hold a word. Repeated rows and doc_ids and null doc_ids
    have a row each, and an empty table gives an empty ledger. Other columns are not read, so their names may clash with
    the measures; those in ``by`` must not. Nothing is shuffled.
    """
    check(rules)
    measured = docs.select("doc_id", *by, measures(F.col("text")).alias("m"))
    return common.stage(measured.select("doc_id", *by, "m.*").withColumn("failed", failure_bits(rules)), "ledger")


def check(rules: Sequence[Rule]) -> None:
    if len({r.bit for r in rules}) < len(rules) or len({r.name for r in rules}) < len(rules) or not all(0 <= r.bit < 63 for r in rules):
        raise ValueError("rules need names and bits (0 to 62) of their own")


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in set(policy.rules))


def decide(rows: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed. Only bits are looked at."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0)


def ablations(rows: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """What each rule does in each policy: the columns ``by``, version, rule, n_rows (of the group), n_dropped (by the policy),
    n_failed (by the rule), n_alone (rows the policy would keep without the rule), seen_with (bits of
    the policy's rules that fail together with it) and always_with (those that fail whenever it does; null if it never does).

    Rows are first counted by their bits, with a map-side part, so what is shuffled is one row a
    task and pattern of bits, however many documents or however large a group. A table without rows has none.
    """
    check(rules)
    bits = {r.name: 1 << r.bit for r in rules}
    patterns = rows.groupBy(*by, "failed").agg(F.count("*").alias("n"))
    asked = F.explode(F.array(*[
        F.struct(F.lit(p.version).alias("version"), F.lit(name).alias("rule"), F.lit(bits[name]).cast("long").alias("bit"),
                 F.lit(mask(p, rules)).cast("long").alias("mask"))
        for p in policies for name in sorted(set(p.rules), key=bits.get)])).alias("q")
    asked = patterns.select(*by, "failed", "n", asked).select(*by, "n", "q.*", F.col("failed").bitwiseAND(F.col("q.mask")).alias("hit"))
    fails = F.col("hit").bitwiseAND(F.col("bit")) != 0

    def count(wanted: Column) -> Column:
        return F.sum(F.when(wanted, F.col("n")).otherwise(0))

    others = F.when(fails, F.col("hit").bitwiseXOR(F.col("bit")))
    return asked.groupBy(*by, "version", "rule").agg(
        F.sum("n").alias("n_rows"), count(F.col("hit") != 0).alias("n_dropped"), count(fails).alias("n_failed"),
        count(F.col("hit") == F.col("bit")).alias("n_alone"), F.coalesce(F.bit_or(others), F.lit(0).cast("long")).alias("seen_with"),
        F.bit_and(others).alias("always_with"))
