"""The hash ring and the URL model against plain versions that look at every row and every split."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tsnorm.llm import queries, sharding, url_filter


@pytest.mark.parametrize("load,shards", [(1.0, 5), (1.3, 5), (1.0, 1)])
def test_ring_is_that_of_a_walk_row_by_row(spark, load, shards):
    rows = spark.range(700).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"))
    at = F.pmod(F.xxhash64(F.lit("key"), "key"), F.lit(sharding.RING)).alias("place")
    got = Counter((r.place, r.shard) for r in sharding.shard(rows, "key", shards=shards, nodes=4, load=load).select(at, "shard").collect())
    nodes = sorted(sharding.virtual_nodes(spark, shards, 4))
    places = sorted(r.place for r in rows.select(at).collect())

    def arc(place):
        return next((i for i, (node, _) in enumerate(nodes) if place <= node), 0)

    most = [len(places) // shards + (s < len(places) % shards) if load <= 1 else math.ceil(len(places) * load / shards) for s in range(shards)]
    taken, over, of_arc = Counter(), [], Counter()
    for i in sorted(map(arc, places)):  # each arc's own shard first, as far as it has room
        if taken[nodes[i][1]] < most[nodes[i][1]]:
            taken[nodes[i][1]] += 1
            of_arc[i, nodes[i][1]] += 1
        else:
            over.append(i)
    for i in over:  # then clockwise to the next with room
        shard = next(s for k in range(1, len(nodes) + 1) if taken[s := nodes[(i + k) % len(nodes)][1]] < most[s])
        taken[shard] += 1
        of_arc[i, shard] += 1
    mine = Counter()
    for (place, shard), n in got.items():
        mine[arc(place), shard] += n
    assert mine == of_arc and sum(got.values()) == len(places)


def pages(seed, n):
    """Urls of run-together words; block and allow pages use different words in part."""
    rng = random.Random(seed)
    words = [["cat", "dog", "cats", "do", "gs", "tree"], ["sun", "moon", "cat", "on", "stars"], ["a", "at", "og"]]
    out = []
    for i in range(n):
        kind = rng.randrange(2)
        name = "".join(rng.choice(words[kind]) for _ in range(rng.randint(1, 4)))
        end = rng.choice(["example.org", f"{name}.com", f"{name}7.net", "m.example.org"])
        url = f"http://{end}/{rng.choice(['es/', 'fr/', 'de/', 'en/1', ''])}{name.title()}/{rng.randrange(30)}"
        text = " ".join(rng.choice(words[kind] + words[2]) for _ in range(20))
        out.append((i, rng.choice([url, url, url, None, "no url"]) if i % 9 == 0 else url, f"<b>{text}</b><script>noise words</script>"))
    return out


def test_url_verdicts_are_those_of_all_splits_and_plain_counts(spark):
    rows = pages(4, 300)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge_urls(frame, queries.RULES).collect()}
    text = [w for _, _, html in rows for w in re.findall(r"[^\W\d_]+", re.sub(r"(?s)<script.*?</script>|<[^>]*>", " ", html).lower())]
    counts, total = Counter(text), len(text)

    def cost(word):
        return math.log(total) - math.log(counts[word]) if word in counts else math.log(total + 1) + (len(word) - 1) * math.log(10)

    def split(name):  # the cheapest of all ways to cut the name
        ways = []
        for cuts in itertools.product((0, 1), repeat=len(name) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(name)]
            parts = [name[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            ways.append((sum(map(cost, parts)), parts))
        return min(ways, key=lambda w: w[0])

    words = url_filter.fit_words(frame.select("html"))
    for name in {"catdogs", "moonstars", "dogsatog", "xyz", "acatz", "sunonmoon", "treecat"}:
        best, parts = split(name)
        assert sum(map(words.cost, words.split(name))) == pytest.approx(best) and "".join(parts) == name
    tokens = {i: [zlib.crc32(t.encode()) % url_filter.FEATURES for t in words.tokens(r.host, r.path)] for i, r in got.items()}
    labelled = {i: r.verdict for i, r in got.items() if r.rule}
    assert len(labelled) > 50 and len(set(labelled.values())) == 2
    n = {v: Counter(f for i, own in labelled.items() if own == v for f in tokens[i]) for v in ("allow", "block")}
    size = {v: sum(c.values()) + url_filter.FEATURES for v, c in n.items()}
    prior = math.log(sum(v == "block" for v in labelled.values()) / sum(v == "allow" for v in labelled.values()))
    for i, r in got.items():
        score = prior + sum(math.log((n["block"][f] + 1) / size["block"]) - math.log((n["allow"][f] + 1) / size["allow"]) for f in tokens[i])
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.verdict == (labelled.get(i) or ("block" if score > 0 else "allow"))
