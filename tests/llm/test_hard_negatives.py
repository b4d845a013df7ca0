"""Mined negatives against all pairs, and the order of the packed keys."""

import random

from pyspark.sql import functions as F

from tsnorm.llm import common, hard_negatives

SCHEMA = "vec_id long, label long, vec array<long>, salt string, block int, score string, dims int"


def table(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "s", 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    return common.stage(frame.withColumn("row", common.row_id()), "vectors")


def brute(rows, anchors, k=5):
    """rows: (row, vec_id, label, vec)."""
    rows = [r for r in rows if r[2] is not None and r[3]]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0, t[2])
    out = []
    for a in [r for r in rows if r[0] in anchors]:
        scored = sorted(((sum(x * y for x, y in zip(a[3], b[3], strict=True)), b[1], b[0], b[2] == a[2]) for b in rows
                         if b[0] != a[0] and len(b[3]) == len(a[3])), key=order)
        for p in [s for s in scored if s[3]][:k]:
            fits = [s for s in scored if not s[3] and 80 * p[0] <= 100 * s[0] <= 100 * p[0]][:k]
            out += [(a[1], p[1], n + 1, s[1], p[0], s[0]) for n, s in enumerate(fits)]
    return out


def compare(spark, rows, **sizes):
    frame = table(spark, rows)
    numbered = [(r.row, r.vec_id, r.label, r.vec) for r in frame.collect()]
    asked = F.expr("vec_id % 10 = 0 or vec_id is null")
    anchors = {r.row for r in frame.filter(asked).collect()}
    got = hard_negatives.hard_negatives(frame, frame.filter(asked), **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    key = lambda t: tuple((x is None, x) for x in t)
    got = sorted(map(tuple, got.collect()), key=key)
    want = sorted(brute(numbered, anchors, sizes["positives"]), key=key)
    assert got == want
    return got


def test_negatives_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "SALTS", 3)
    monkeypatch.setattr(hard_negatives, "PARTITION", 50)
    rng = random.Random(8)
    rows = [(i, rng.randrange(3), [rng.randint(-3, 6) for _ in range(4)]) for i in range(200)]
    rows += [(i, 0, [3, 3, 3, 3]) for i in range(300, 340)]  # one hot vector, ties everywhere
    rows += [(i, 1, [3, 3, 3, 3]) for i in range(340, 360)]
    rows += [rows[10], rows[10], (None, 1, [3, 3, 3, 2]), (None, 2, [1, 1, 1, 1])]
    rows += [(400, None, [1, 1, 1, 1]), (410, 1, None), (420, 1, []), (430, 1, [5, 5]), (431, 1, [5, 4]), (432, 2, [5, 4])]
    rows += [(440, 9, [6, 6, 6, 6]), (450, 8, [0, 0, 0, 0]), (451, 8, [0, 0, 0, 0]), (460, 7, [-5, -5, -5, -5]), (461, 7, [5, 5, 5, 5])]
    got = compare(spark, rows, positives=5, negatives=5)
    assert any(g[4] == 0 for g in got) and max(g[2] for g in got) == 5


def test_without_rows_anchors_or_partners(spark):
    assert compare(spark, [], positives=5, negatives=5) == []
    assert compare(spark, [(1, 1, [1]), (2, 2, [1])], positives=5, negatives=5) == []  # no anchor
    assert compare(spark, [(10, 1, [1]), (2, 2, [1])], positives=5, negatives=5) == []  # no positive
    assert compare(spark, [(10, 1, [2]), (11, 1, [2]), (12, 2, [2])], positives=5, negatives=5) == [(10, 11, 1, 12, 4, 4)]


def test_packed_keys_sort_as_their_numbers():
    rng = random.Random(2)
    ends = [-(2**63), -1, 0, 1, 2**63 - 1]
    rows = [(rng.choice(ends), rng.choice(ends), rng.randrange(2), rng.choice(ends), rng.choice(ends)) for _ in range(300)]
    by_key = sorted(rows, key=lambda r: hard_negatives.key_of(*r))
    assert by_key == sorted(rows, key=lambda r: (r[0], -r[1], *r[2:]))


def test_windows_hold_whole_scores():
    assert hard_negatives.windows([100, 100, 7, 0, -5]) == [(0, 0), (6, 7), (80, 100)]
