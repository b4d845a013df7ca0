"""Near-duplicates by SuperMinHash signatures, banding, exact verification and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.llm import common
from tsnorm.llm.components import components

SKETCH = "doc_id long, n_shingles long, hi long, lo long, bands array<long>"
FILTER_BITS = 1 << 27
BLOCK = 256  # documents of a block in block-wise comparison


def shingles(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: the sorted distinct hashes of all rows in turn, and each row's first one. With
    fewer than ``k`` words the whole sequence is one shingle; a text without words has none."""
    data, offsets = common.text_bytes(column)
    for lo, hi in common.slices(offsets, 1 << 19):
        part, bounds = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends, first = common.words(part, bounds, common.SPACED_WORD)
        hashes, n = common.word_hashes(part, starts, ends), np.diff(first)
        grams = common.gram_hashes(hashes, k)
        edges = first.tolist()
        sets = []
        for r, count in enumerate(n.tolist()):
            if count >= k:
                sets.append(np.unique(grams[edges[r]:edges[r + 1] - k + 1]))
            else:
                sets.append(common.gram_hashes(hashes[edges[r]:edges[r + 1]], count) if count else grams[:0])
        yield lo, hi, np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def superminhash(elements: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """Signatures of ``m`` components for rows of elements. Element x walks a random permutation of the
    components; at step j it offers the rank (j, random) to its j-th component, which keeps the
    least. Steps are taken by all elements of a row together, and a row stops as soon as every
    component has a rank below the next step: no later one can be less."""
    rows = len(first) - 1
    sign = np.full(rows * m, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(first))
    x, order = elements, None
    for j in range(m):
        u = common.mix(x + np.uint64(int(common.GOLDEN) * (j + 1) % 2**64))
        k = (np.uint64(j) + (((u & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        at = np.arange(len(x))
        if order is None:
            slot = k
        else:
            slot = order[at, k].astype(np.int64)
            order[at, k] = order[:, j]
        np.minimum.at(sign, row * m + slot, (np.uint64(j) << np.uint64(32)) | (u >> np.uint64(32)))
        open_rows = sign.reshape(rows, m).max(axis=1) >= np.uint64(j + 1) << np.uint64(32)
        keep = open_rows[row]
        if not keep.any():
            break
        if order is None:
            x, row, k = x[keep], row[keep], k[keep]
            order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(x), 1))
            order[np.arange(len(x)), k] = 0
        elif keep.mean() < 0.8:
            x, row, order = x[keep], row[keep], order[keep]
    return sign.reshape(rows, m)


def band_hashes(signatures: np.ndarray, bands: int) -> np.ndarray:
    width = signatures.shape[1] // bands
    out = np.tile(common.mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signatures), 1))
    for i in range(width):
        out = common.mix(out * np.uint64(0xA0761D6478BD642F) + signatures[:, i::width][:, :bands])
    return out


def sketched(docs: DataFrame, k: int, bands: int, width: int) -> DataFrame:
    """Size, 128-bit digest and band hashes of every document's set, staged."""

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets, first in shingles(batch.column(1), k):
                hashed = band_hashes(superminhash(sets, first, bands * width), bands)
                raw, edges = memoryview(sets.tobytes()), (first * 8).tolist()
                digest = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                     common.ragged(common.signed(hashed.ravel()), np.arange(hi - lo + 1) * bands, pa.int64())],
                    ["doc_id", "n_shingles", "hi", "lo", "bands"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.stage(slim.mapInArrow(scan, SKETCH), "sketch")


def candidates(classes: DataFrame) -> DataFrame:
    """Stars: each member of a bucket with the bucket's least id; id, center, both distinct. A bucket
    is never gathered: its least id comes from an aggregate, and only rows that may share a bucket are joined."""
    spread = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = common.stage(
        spread.groupBy("bucket").agg(F.min("id").alias("center"), F.count("id").alias("n"))
        .filter("n > 1").select("bucket", "center"), "buckets")
    bits = classes.sparkSession.sparkContext.broadcast(
        common.bit_filter(buckets, "bucket", common.filter_size(buckets.count(), FILTER_BITS)))

    @common.tidy
    def spread_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy()
            keep = common.may_hold(bits.value, flat.view(np.uint64))
            row = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))[keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(flat[keep])], ["id", "bucket"])

    shared = classes.select("id", "bands").mapInArrow(spread_shared, "id long, bucket long")
    return shared.join(buckets, "bucket").filter("id <> center").select("id", "center").distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Full shingle sets (sorted 64-bit hashes) of the wanted ids, one row per id: id, set."""

    @common.tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets, first in shingles(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), common.binary(sets, first)], ["id", "set"])

    slim = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    _, some = common.divide(slim, F.xxhash64("id"), wanted.select(F.xxhash64("id").alias("h")), FILTER_BITS)
    return common.stage(
        some.mapInArrow(scan, "id long, set binary").join(wanted, "id", "left_semi"), "sets")


def similar(inter: int, a: int, b: int, percent: int) -> bool:
    return 100 * inter >= percent * (a + b - inter)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """id, center, linked: whether the full sets of a pair are similar enough."""

    @common.tidy
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                both = np.concatenate((x, y))
                both.sort()
                linked.append(similar(int((both[1:] == both[:-1]).sum()), len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("center"), pa.array(linked, pa.bool_())], ["id", "center", "linked"])

    return (
        pairs.join(sets.select(F.col("id").alias("center"), F.col("set").alias("b")), "center")
        .join(sets.withColumnRenamed("set", "a"), "id")
        .select("id", "center", "a", "b").mapInArrow(check, "id long, center long, linked boolean")
    )


def rest_links(stars: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that the stars leave open: two members of one star, neither its center, whose components
    still differ. Members outside the center's component are compared with all members of the
    star, in blocks of both; each block is one group of bounded size and yields one link per member
    and component met. Nothing is left out, whatever the size of a star."""
    own = labels.withColumnRenamed("root", "mine")
    of_center = labels.select(F.col("id").alias("center"), F.col("root").alias("theirs"))
    members = (
        stars.select("id", "center").join(own, "id", "left").join(of_center, "center", "left")
        .select("center", "id", F.coalesce("mine", "id").alias("root"), F.coalesce("theirs", "center").alias("center_root"))
        .withColumn("apart", F.col("root") != F.col("center_root"))
    )
    members = common.stage(members, "members")
    size = (
        members.groupBy("center").agg(
            F.count("id").alias("n"), F.sum(F.col("apart").cast("int")).alias("n_apart"),
            F.min("root").alias("least"), F.max("root").alias("most"))
        .filter("least <> most")
        .select("center", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n_apart") / BLOCK).cast("int").alias("apart_blocks"))
    )
    size = common.stage(size, "open_stars")
    if size.isEmpty():
        return None
    dealt = members.join(size, "center").withColumns({
        "i": F.pmod(F.xxhash64("id"), "apart_blocks").cast("int"), "j": F.pmod(F.xxhash64("id", F.lit(1)), "blocks").cast("int")})
    left = dealt.filter("apart").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(0))
    right = dealt.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("apart_blocks") - 1))).withColumn("side", F.lit(1))
    columns = ["center", "i", "j", "side", "id", "root"]
    rows = left.select(columns).unionByName(right.select(columns)).join(sets, "id")

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        links: dict[tuple[int, int], int] = {}
        x, y = block[block["side"] == 0], block[block["side"] == 1]
        if len(x) and len(y):
            sets_x = [np.frombuffer(s, np.uint64) for s in x["set"]]
            sizes = np.array([len(s) for s in sets_x])
            flat, owner = np.concatenate(sets_x), np.repeat(np.arange(len(x)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            ids, roots = x["id"].to_numpy(), x["root"].to_numpy()
            for other, root, raw in zip(y["id"], y["root"], y["set"], strict=True):
                s = np.frombuffer(raw, np.uint64)
                lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                n = hi - lo
                found = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                inter = np.bincount(owner[found], minlength=len(x))
                for i in np.flatnonzero((100 * inter >= percent * (sizes + len(s) - inter)) & (roots != root)).tolist():
                    links.setdefault((int(ids[i]), int(root)), int(other))
        return pd.DataFrame({"id": [a for a, _ in links], "center": list(links.values())}, dtype="int64")

    return rows.groupBy("center", "i", "j").applyInPandas(compare, "id long, center long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, width: int = 5) -> DataFrame:
    """Groups of documents linked by 100 * shared >= percent * all of their distinct word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. Equal sets are one class, led by its
    least doc_id. SuperMinHash signatures of ``bands * width`` components, drawn in one walk per
    element, are cut into bands; classes that share a band are candidates. A pair at the limit
    similarity 0.8 shares none of 40 bands of 5 with probability 1e-7. Candidates are confirmed on full
    sets, first as stars, then block by block where components of a star still differ, so no
    pair of candidates is lost and no group is expanded into its pairs. Union-find labels follow.

    Returns one row per input row: doc_id, n_shingles, component_id (least doc_id reachable),
    n_links (links found to other classes; a spanning set, not all pairs) and kept (doc_id =
    component_id). Null and empty texts have no shingles and stand alone. Rows that repeat a
    doc_id belong to the classes of each text; as they share its name, all of them are joined in one
    component and each is kept if the doc_id is least. A null doc_id links nothing: component_id
    is its class's least doc_id, null if there is none, and kept is true only then.
    """
    sketch = sketched(docs, shingle, bands, width)
    named = sketch.filter("n_shingles > 0 and doc_id is not null")
    led = common.stage(  # equal sets have equal bands
        named.groupBy("hi", "lo").agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands")), "leaders")
    classes = led.select("hi", "lo", "id")
    stars = common.stage(candidates(led), "stars")
    wanted = common.stage(stars.select("id").union(stars.select("center")).distinct(), "wanted")
    sets = sets_of(docs, wanted, shingle)
    checked = common.stage(verified(stars, sets, percent), "checked")
    # a doc_id with several texts joins the classes of all of them
    several = named.groupBy("doc_id").agg(F.min("hi").alias("a"), F.max("hi").alias("b")).filter("a <> b").select("doc_id")
    names = named.join(several, "doc_id").join(classes, ["hi", "lo"]).select(F.col("id"), F.col("doc_id").alias("center"))
    links = checked.filter("linked").select("id", "center").unionByName(names)
    labels = components(links)
    rooted = classes.join(labels, "id", "left").withColumn("root", F.coalesce("root", "id"))
    more = rest_links(checked, labels, sets, percent)
    if more is not None:
        more = common.stage(more, "more_links")
        links = links.unionByName(more)
        # these links join components that are known: only their roots go through union-find again
        ends = more.join(labels.toDF("id", "a"), "id", "left").join(labels.toDF("center", "b"), "center", "left")
        joined = components(ends.select(F.coalesce("a", "id").alias("a"), F.coalesce("b", "center").alias("b")))
        rooted = rooted.join(joined.toDF("root", "further"), "root", "left").withColumn("root", F.coalesce("further", "root"))
    degree = (
        links.select("id").unionByName(links.select(F.col("center").alias("id"))).groupBy("id").agg(F.count("id").alias("n_links")))
    label = rooted.join(degree, "id", "left").select("hi", "lo", "root", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    filled = F.col("n_shingles") > 0
    return (
        sketch.select("doc_id", "n_shingles", "hi", "lo").join(label, ["hi", "lo"], "left")
        .withColumn("component_id", F.when(filled, F.col("root")).otherwise(F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
    )
