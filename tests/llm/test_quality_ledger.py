"""The ledger's measures against plain Python, policies and ablations against counts row by row."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tsnorm.llm import quality

SCHEMA = "doc_id long, text string, source string, n_words string, failed int, m string, kept int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s", "x", 1, "m", 2) for i, t in rows], SCHEMA)


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    again = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again)}


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t", "one", "#" * 50, "é😀  x\x1cy a\x85b", "a " * 9, "a " * 8, "a\n" * 30, "x y z\r\nx y z\nx y z\n"]
    out += [" ".join(rng.choice("ab" if n % 3 else "abcdefghijklmnopqrst") for _ in range(rng.randint(0, 60))) for n in range(80)]
    out += ["\n".join(rng.choice(["p q", "r & s", "", " "]) for _ in range(rng.randint(0, 12))) for _ in range(30)]
    passage = " ".join(f"w{i}" for i in range(3000))
    return [*out, passage, passage + " end " + passage, "w " * 200_000, " ".join(str(i) for i in range(150_000)), "y" * 2_000_000]


def test_measures_are_those_of_plain_python(spark):
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "one"), (3, "one")]
    got = quality.ledger(documents(spark, rows)).collect()
    want = [{"doc_id": i, **plain(t)} for i, t in rows]
    assert len(got) == len(want)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_words"])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert {k: g[k] for k in w} == w
        fails = [
            w["n_words"] < 20, 100 * w["n_repeat_words"] > 30 * w["n_words"], 10 * w["n_symbols"] > w["n_words"],
            100 * w["n_dup_lines"] > 30 * w["n_lines"], w["word_chars"] < 2 * w["n_words"], w["word_chars"] > 20 * w["n_words"]]
        assert g["failed"] == sum(1 << i for i, f in enumerate(fails) if f)


def test_policies_and_ablations_read_the_bits(spark):
    rows = quality.ledger(documents(spark, list(enumerate(texts()))))
    bits = [r.failed for r in rows.collect()]
    place = {r.name: 1 << r.bit for r in quality.RULES}
    for policy in quality.POLICIES:
        mask = sum(place[n] for n in policy.rules)
        assert quality.decide(rows, policy).filter("kept").count() == sum(b & mask == 0 for b in bits)
    got = {(r.version, r.rule): r for r in quality.ablations(rows).collect()}
    assert len(got) == sum(len(p.rules) for p in quality.POLICIES)
    for policy in quality.POLICIES:
        mask = sum(place[n] for n in policy.rules)
        for name in policy.rules:
            bit, r = place[name], got[policy.version, name]
            with_it = [b & mask ^ bit for b in bits if b & bit]
            seen = always = 0
            for b in with_it:
                seen |= b
            if with_it:
                always = mask
                for b in with_it:
                    always &= b
            assert (r.n_rows, r.n_dropped, r.n_failed) == (len(bits), sum(b & mask != 0 for b in bits), len(with_it))
            assert r.n_alone == sum(b == 0 for b in with_it)
            assert r.seen_with == seen and r.always_with == (always if with_it else None)


def test_policies_come_after_the_ledger(spark):
    rows = quality.ledger(documents(spark, [(1, "a b"), (2, "c " * 30)]), by=["source"])
    late = quality.Policy(9, ("repeated_words",))
    assert {r.doc_id: r.kept for r in quality.decide(rows, late).collect()} == {1: True, 2: False}
    assert [r.source for r in quality.ablations(rows, [late], by=["source"]).collect()] == ["s"]


def test_empty_tables_and_bad_rules(spark):
    rows = quality.ledger(documents(spark, []))
    assert rows.count() == 0 and quality.ablations(rows).count() == 0
    with pytest.raises(ValueError):
        quality.ledger(documents(spark, []), [quality.RULES[0], quality.RULES[0]])
    with pytest.raises(ValueError):
        quality.ledger(documents(spark, []), [quality.Rule(63, "sign", lambda: F.lit(True))])


def test_no_python_worker_and_no_shuffle(spark):
    plan = quality.decide(
        documents(spark, []).select("doc_id", quality.measures(F.col("text")).alias("m")).select("m.*").withColumn("failed", quality.failure_bits()),
        quality.POLICIES[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
