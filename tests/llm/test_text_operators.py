"""The text operators on small tables against brute force: nulls, empty and long texts, ties, repeats, empty tables."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tsnorm.llm import (
    chat, common, components, decontamination, language, near_dedup, packing, queries, search, sharding, substring_dedup, token_files, tokens,
    url_filter,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, ids int, shard string, spans int"


def documents(spark, rows):
    """Rows of (doc_id, text) with further columns whose names operators use too."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 1, 2, "x", 3) for i, t in rows], SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "tu", "er", "ß", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


ODD = [
    (1, None), (2, ""), (3, "..."), (4, "one"), (4, "one"), (None, "no id here"), (5, prose(1, 40)), (6, prose(1, 40)), (7, prose(2, 5000)),
    (11, "x <|endoftext|> y<|endoftext|><|endoftext|>\n z"),
    (8, "<turn> \x00 \u2028 é\u0301 " + prose(1, 39)), (9, "\n \t"), (10, "Two  words\n\nand  more."),
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)  # as it is
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(reference):
    rng, pieces = random.Random(3), tokens.Pieces(PATH)
    marks = [" ", "\n", "  ", "a", "é", "ß.", ",", "'s", "1", "\t", "\r\n", "Word", "\x00", "\x1c", "\x85", "漢", "!?", "<|endoftext|>", "\n\n", "ʰ"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 9))) for _ in range(5000)] + [t for _, t in ODD if t]
    marks += ["\xa0", "\u2003", "\u3000", " x", "Ä", "×", "ɐ", "_", "\u0300", "😀", "Ω"]
    texts += ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [None, " it's", prose(4, 20_000)]
    ids, bounds = pieces.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [reference(t) for t in texts]


def test_packing_places_every_id_once(spark, reference):
    rows = packing.pack(documents(spark, ODD).repartition(3), PATH, length=64).collect()
    want = sorted(np.array([*reference(t), 0], "<u4").tobytes() for _, t in ODD)
    assert sum(r["length"] for r in rows) == sum(len(w) // 4 for w in want)
    by_sequence = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["start"] + r["length"] <= r["doc_tokens"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    stream = b""
    for s in range(len(by_sequence)):
        at = 0
        for offset, length, ids in sorted(by_sequence[s]):
            assert offset == at
            at, stream = at + length, stream + ids
        assert at == 64 or s == len(by_sequence) - 1
    whole = packing.sequences(packing.pack(documents(spark, ODD), PATH, length=64)).collect()
    assert sum(r["n_ids"] for r in whole) == len(stream) // 4 and all(len(r["ids"]) == 4 * r["n_ids"] for r in whole)
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_token_files_round_trip(spark, reference):
    path = common.new_folder(spark, "files")
    token_files.write(documents(spark, ODD).repartition(3), path, PATH, end=2)
    got = sorted((r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(token_files.read(spark, path)).collect())
    start, want = 0, []
    for i, t in sorted(ODD, key=lambda r: (r[0] or 0, len(r[1] or ""))):
        ids = [*reference(t), 2]
        want.append((i or 0, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    assert token_files.read(spark, path).filter("doc_id = 7").count() == 1
    empty = common.new_folder(spark, "files")
    token_files.write(documents(spark, []), empty, PATH, end=2)
    assert token_files.digests(token_files.read(spark, empty)).count() == 0


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(5)
    rows = [r for r in ODD if r[0] != 4] + [(4, "one")]
    for g in range(12):
        base = prose(100 + g, rng.randint(3, 80)).split(" ")
        for c in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(["kalo", "zz", "mi"])
            rows.append((100 + 20 * g + c, " ".join(words)))
    for k in (2, 5):
        got = {r["doc_id"]: r for r in near_dedup.near_duplicates(documents(spark, rows), shingle=k).collect()}
        sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
        label = {i: i for i in sets}

        def find(i, label=label):
            while label[i] != i:
                i = label[i]
            return i

        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
        for i, s in sets.items():
            assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(s), find(i), find(i) == i), i
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0
    twice = near_dedup.near_duplicates(documents(spark, [(1, "a b c d e f"), (3, "a b c d e f"), (3, "u v w x y z"), (5, "u v w x y z")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in twice} == {(1, 1), (3, 1), (5, 1)}


def test_superminhash_estimates_similarity():
    a, b = np.arange(1000, dtype=np.uint64), np.arange(250, 1250, dtype=np.uint64)
    sign = near_dedup.superminhash(common.mix(np.concatenate((a, b))), np.array([0, 1000, 2000]), 200)
    assert abs((sign[0] == sign[1]).mean() - 0.6) < 0.1
    for n in (1, 7, 150):
        one = near_dedup.superminhash(common.mix(np.arange(n, dtype=np.uint64)), np.array([0, n]), 200)
        again = near_dedup.superminhash(common.mix(np.arange(n, dtype=np.uint64)[::-1].copy()), np.array([0, n]), 200)
        assert (one == again).all() and one.max() < np.iinfo(np.uint64).max


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


def test_substrings_repeated_across_documents_go(spark):
    passage = prose(50, 60)
    rows = [(i, prose(200 + i, 30 + i) + (f"\n{passage} " if i % 2 else " ") + prose(300 + i, 25)) for i in range(1, 13)]
    rows += [(20, passage + " " + prose(60, 20) + " " + passage), *ODD]
    got = {}
    for r in substring_dedup.dedup_substrings(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    inner = " ".join(passage.split(" ")[15:45])
    for i, t in rows:
        r = next(x for x in got[i] if x["n_chars"] == (None if t is None else len(t)))
        if t is None:
            assert r["text"] is None and r["removed_spans"] == []
            continue
        raw, left, at = t.encode(), b"", 0
        for s in r["removed_spans"]:
            left, at = left + raw[at:s["begin"]], s["end"]
        assert (left + raw[at:]).decode() == r["text"]
        if (i is not None and 1 < i < 13 and i % 2 and t.endswith(prose(300 + i, 25))) or i == 20:
            assert r["removed_words"] >= 20 and inner not in r["text"], i
        elif i != 6 and i != 8:
            assert r["text"] == t, i
    assert substring_dedup.dedup_substrings(documents(spark, [])).count() == 0


def repeated_words(rows, least=20):
    """Brute force: for each row the words that lie in a run of ``least`` words that stands in a row of smaller
    doc_id, or earlier in the same row without overlap."""
    spans = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", t.encode())] for _, t in rows]
    runs = [[t.encode()[s[i][0]:s[i + least - 1][1]] for i in range(len(s) - least + 1)] for (_, t), s in zip(rows, spans, strict=True)]
    owner = {}
    for (doc, _), own in zip(rows, runs, strict=True):
        for run in own:
            owner[run] = min(doc, owner.get(run, doc))
    out = []
    for (doc, _), own, s in zip(rows, runs, spans, strict=True):
        first, gone = {}, set()
        for i, run in enumerate(own):
            if owner[run] < doc or i - first.setdefault(run, i) >= least:
                gone.update(range(i, i + least))
        out.append((s, gone))
    return out


def same_as_brute_force(spark, rows):
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(documents(spark, rows).repartition(5)).collect()}
    for (doc, text), (spans, gone) in zip(rows, repeated_words(rows), strict=True):
        r = got[doc]
        inside = {i for i, (a, b) in enumerate(spans) for x in r["removed_spans"] if x["begin"] <= a and b <= x["end"]}
        assert inside == gone and r["removed_words"] == len(gone), doc
    return got


def test_no_repeated_passage_is_missed(spark):
    """Passages of 20 to 100 words, periodic ones too, each in two documents between words of their own."""
    rows = []
    for i in range(600):
        n, line = (20, 21, 51, 60, 100)[i % 5], prose(9000 + i, i % 9 + 1).split(" ")
        passage = prose(5000 + i, n) if i % 4 else " ".join((line * n)[:n])
        rows += [(2 * i + k, f"{prose(20000 + 2 * i + k, 15)}\n{passage} {prose(40000 + 2 * i + k, 15)}") for k in (0, 1)]
    rows += [(5000, " ".join(["a"] * 100)), (5001, prose(1, 30) + " x " + prose(1, 30)), (5002, " ".join(["a b c d e f g"] * 10))]
    got = same_as_brute_force(spark, rows)
    assert all(got[2 * i + 1]["removed_words"] >= (20, 21, 51, 60, 100)[i % 5] for i in range(600))
    assert all(got[2 * i]["removed_words"] == 0 for i in range(600) if i % 4)


def test_unique_text_of_repeated_pieces_stays(spark):
    """Documents put together of short pieces, cut by content, that all stand in earlier ones, but never in this order."""
    def ends_a_chunk(piece):
        words = piece.split(" ")
        return len(words) in words_of(" ".join(words + ["x"] * 5)).cuts(6)
    pieces = [p for p in (prose(60000 + i, 3 + i % 5) for i in range(900)) if ends_a_chunk(p)][:60]
    rows = [(i, f"{prose(800 + i, 12)} {pieces[0]} {p} {prose(900 + i, 12)}") for i, p in enumerate(pieces)]
    rng = random.Random(4)
    rows += [(100 + i, " ".join(rng.sample(pieces, 20))) for i in range(40)]
    rows += [(200, rows[70][1].partition(" ")[2])]
    got = same_as_brute_force(spark, rows)
    assert not any(r["removed_words"] for doc, r in got.items() if doc < 200) and got[200]["text"] == ""


def words_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return substring_dedup.Words.of(data, np.array([0, len(data)]))


def test_gear_chunks_resist_shifts():
    text = prose(9, 400)
    def cut(s):
        words = s.split(" ")
        return [tuple(words[a:b]) for a, b in zip(*words_of(s).chunks(6), strict=True)]
    assert len(set(cut("new words first " + text)) & set(cut(text))) >= len(cut(text)) - 4 > 80
    assert all(6 <= len(c) <= 11 for c in cut(text))


def test_every_run_holds_a_chunk_of_its_own():
    """Wherever a run of words stands, one chunk in it is the same; texts of few distinct words among them."""
    rng = random.Random(12)
    for n in (8, 20, 33):
        window = substring_dedup.chunk_window(n)
        for k in range(300):
            some = prose(k, 1 + k % 7).split(" ") if k % 2 else prose(k, 200).split(" ")
            run = [rng.choice(some) for _ in range(n)]
            found = []
            for side in range(2):
                before, after = (prose(1000 * side + 7 * k + j, 1 + k % 11).split(" ") for j in (1, 2))
                text = before + run + after
                begins, ends = words_of(" ".join(text)).chunks(window)
                found.append({tuple(text[a:b]) for a, b in zip(begins, ends, strict=True) if len(before) <= a and b <= len(before) + n})
            assert found[0] & found[1], (n, k)


def test_copies_of_a_text_are_one_passage(spark):
    text, short = " \n" + prose(5, 300) + "\n ", prose(6, 19)
    rows = [(i, text) for i in range(40)] + [(50 + i, short) for i in range(5)] + [(7, text), (None, text)]
    got = substring_dedup.dedup_substrings(documents(spark, rows).repartition(6)).collect()
    for r in got:
        if r.text is not None and r.doc_id is not None and r.doc_id >= 50:
            assert r.text == short
        elif r.doc_id == 0:
            assert r.text == text
        else:
            assert r.text.strip() == "" and r.removed_words == 300
    assert len(got) == len(rows)


def plain_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_decontamination_matches_all_windows(spark):
    rng = random.Random(8)
    items = [(i, prose(400 + i, n)) for i, n in enumerate((30, 12, 10, 9, 3, 1, 30))] + [(50, None), (51, ""), (52, "..."), (6, prose(406, 30))]
    items.append((60, items[0][1]))
    rows = list(ODD)
    for i in range(40):
        w = prose(500 + i, rng.randint(0, 60)).split(" ")
        for _ in range(rng.randint(0, 3)):
            s = plain_words(rng.choice(items[:7])[1])
            a = rng.randint(0, max(0, len(s) - 4))
            w[rng.randrange(len(w)):0] = [x.upper() if rng.random() < 0.3 and x.isascii() else x + rng.choice(["", ",", "."]) for x in s[a:a + rng.randint(3, 25)]]
        rows.append((1000 + i, " ".join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontamination.hits(documents(spark, rows), bench).collect():
        got.setdefault((r["doc_id"], r["n_words"]), []).append((r["n_hit"], r["items"]))
    for i, t in rows:
        w, hit, names = plain_words(t), set(), set()
        for item, s in items:
            s = plain_words(s)
            n = min(10, len(s))
            windows = {tuple(s[a:a + n]) for a in range(len(s) - n + 1)} if n else set()
            for a in range(len(w) - n + 1) if n else ():
                if tuple(w[a:a + n]) in windows:
                    hit |= set(range(a, a + n))
                    names.add(item)
        assert (len(hit), sorted(names)) in got[i, len(w)], i
    assert decontamination.hits(documents(spark, []), bench).count() == 0
    assert {r["n_hit"] for r in decontamination.hits(documents(spark, rows), bench.limit(0)).collect()} == {0}
    kept = decontamination.clean(documents(spark, rows), bench)
    assert kept.columns == documents(spark, []).columns and kept.count() < len(rows)


def test_languages_are_told_on_held_out_texts(spark):
    rng = random.Random(4)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["ße", "ür", "sch"], "cc": ["th", "ing", "wh"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k]) for _ in range(3)) for _ in range(20)), k) for i, k in enumerate(list(parts) * 40)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 .", "cc"), (903, "kalomi", None), (None, "thing", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    filters = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    got = language.predict(docs, filters).join(docs, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all(r["lang_pred"] == (r["lang"] or "aa") for r in got if r["doc_id"] < 900 or r["doc_id"] == 903)
    assert {r["lang_pred"] for r in got if 900 <= r["doc_id"] < 903} == {"und"}
    nothing = language.fit(docs.filter("doc_id < 0"))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.keep_known(docs, filters, 0.3).count() == 122 and language.predict(docs.limit(0), filters).count() == 0


def test_bit_slices_answer_for_every_language():
    filters = language.Filters([f"l{i}" for i in range(70)], np.zeros((language.SLOTS, 2), np.uint64), np.zeros(70))
    codes = np.arange(1, 71, dtype=np.uint32)
    for i, c in enumerate(codes):
        for p in language.probes(np.array([c])):
            filters.masks[p, i // 64] |= np.uint64(1) << np.uint64(i % 64)
    total, found = filters.hits(codes, np.zeros(70, int), 1)
    assert total[0] == 70 and (found[0] >= 1).all() and found.sum() < 75


def test_search_matches_all_products(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), [int(x) for x in rng.integers(-20, 20, 8) * rng.choice([1, 3])]) for i in range(300)]
    vectors += [(300, [0] * 8), (301, vectors[5][1]), (302, vectors[5][1]), (5, vectors[5][1]), (None, vectors[5][1]), (303, [1, 2])]
    rows = common.stage(spark.createDataFrame(vectors, "vec_id long, vec array<long>").select(common.row_id().alias("row"), "*"), "v")
    got = {}
    for r in search.top_products(rows, rows.filter("vec_id % 10 = 0 or vec_id = 303"), k=5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q, v in vectors[:300:10] + [vectors[300]]:
        scored = sorted((-int(np.dot(v, w)), i is None, i or 0) for i, w in vectors if len(w) == 8 and i != q)[:5]
        assert [got[q][k] for k in range(1, 6)] == [(None if none else i, -s) for s, none, i in scored], q
    assert 303 not in got and search.top_products(rows.limit(0), rows.limit(0)).count() == 0


def test_ring_keeps_counts_even_and_moves_little(spark):
    rows = documents(spark, [(i, "t") for i in range(3000)] + [(7, "same")] * 1500 + [(None, None)] * 3)
    placed = sharding.shard(rows, "doc_id", shards=16).collect()
    by = {}
    for r in placed:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(placed) == 4503 and len(by) == 16 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    loose = {n: {r["doc_id"]: r["shard"] for r in sharding.shard(rows.filter("doc_id <> 7"), "doc_id", shards=n, load=1.5).collect()} for n in (8, 9)}
    assert sum(loose[8][i] != loose[9][i] for i in loose[8]) < 0.35 * len(loose[8])
    assert sharding.shard(rows.limit(0), "doc_id").count() == 0


def test_urls_rules_and_words(spark):
    pages = [(1, "HTTPS://A.Example.ORG/x?y"), (2, "http://example.org/es/1"), (3, "http://m.example.org/en/17"), (4, "http://example.com/fr/"),
             (5, "http://b.com/de/3#f"), (6, "http://catdog.net/de/3"), (7, None), (8, "nothing"), (9, "http://corg/"), (10, "x://"), (1, "HTTPS://A.Example.ORG/x?y")]
    html = "<script>junk()</script><p>cat dog cat dog</p>"
    df = spark.createDataFrame([(i, u, html) for i, u in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, queries.RULES).collect()}
    assert [got[i]["rule"] for i in range(1, 11)] == ["org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, None, None, None, None]
    assert [got[i]["verdict"] for i in range(1, 6)] == ["allow", "block", "block", "allow", "block"]
    assert (got[1]["host"], got[1]["path"]) == ("a.example.org", "/x") and (got[8]["host"], got[8]["path"]) == ("", "")
    words = url_filter.fit_words(df.select("html"))
    assert words.split("catdogcat") == ["cat", "dog", "cat"] and words.total == 4 * len(pages)
    assert url_filter.judge_urls(df.limit(0), queries.RULES).count() == 0


def test_chat_windows_read_back(spark):
    rng = random.Random(6)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", prose(c, 10)))
        for t in range(1, rng.choice([2, 5, 40])):
            rows.append((c, t, ["user", "assistant"][t % 2], prose(1000 * c + t, rng.choice([0, 3, 30, 90]))))
    rows += [(20, 0, "system", "only"), (21, 0, None, None), (21, None, "assistant", "\\l<turn>\\b</turn>\n\\n"), (22, 1, "a\nb<", "x"), (22, 1, "a\nb<", "x"),
             (None, 1, "assistant", "z"), (23, 5, "assistant", prose(1, 900)), (23, 6, "assistant", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, span int").repartition(3)
    df = df.withColumn("n", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + 4)  # words stand for tokens here
    formatted = chat.windows(df, budget=200, history=50, tokens="n")
    back = sorted(chat.read_back(formatted).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["window"]))
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    got, loss = {}, {}
    for r in back:
        got.setdefault(r["conv_id"], []).extend((x["role"], x["text"]) for x in r["turns"])
        loss[r["conv_id"]] = loss.get(r["conv_id"], "") + r["target"]
    assert got == want
    assert loss == {c: "".join(t for role, t in v if role == "assistant") for c, v in want.items()}
    for r in formatted.collect():
        assert r["tokens"] <= 200 or r["n_turns"] == 1
    assert any(r["n_context"] for r in formatted.collect()) and chat.windows(df.limit(0)).count() == 0


def test_chat_budgets_hold_for_a_tokenizer(spark, reference):
    """Counted by bytes, or by the tokenizer itself in a column, no window has more ids than it says, nor than the budget."""
    rng = random.Random(16)
    odd = ["x9" * 60, "0123456789abcdef" * 20, "漢字" * 40, "\U0001f600" * 9, "\\<\n" * 30, "<|endoftext|> a", " " * 50]
    rows = [(c, t, ["system", "user", "assistant"][t % 3], rng.choice([*odd, prose(t, rng.choice([1, 9, 30]))])) for c in range(8) for t in range(25)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spelled = {r: reference(f"<turn>{r[0]}\n{r[1]}</turn>\n") for r in {(x[2], x[3].replace("\\", "\\b").replace("<", "\\l")) for x in rows}}
    ids = spark.createDataFrame([(*k, len(v)) for k, v in spelled.items()], "role string, told string, ids long")
    exact = df.withColumn("told", chat.escape(F.col("text"))).join(ids, ["role", "told"])
    sizes = []
    for formatted in (chat.windows(df, 700, 200), chat.windows(exact, 700, 200, tokens="ids")):
        found = formatted.collect()
        for r in found:
            n = len(reference(r["text"]))
            assert n <= r["tokens"] and (r["tokens"] <= 700 or r["n_turns"] - (r["window"] == 0) <= 1)  # the system turn is one of the first window
        sizes.append(len(found))
    assert sizes[1] < sizes[0]


def test_pipeline_stages_match_plain_python(spark, tmp_path):
    """What each stage before packing keeps and what its texts become, on planted copies, passages, benchmark words and clean documents."""
    items = [(i, prose(70000 + i, 30)) for i in range(5)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, prose(71000 + i, 60 + i)) for i in range(40)]
    for i in range(10):
        copy = rows[i][1].split(" ")
        copy[7 * i % 50] = "changed"
        rows += [(100 + i, " ".join(copy)), (120 + i, rows[i][1])]
        passage = " ".join(rows[20 + i][1].split(" ")[10:10 + 15 + i])
        rows += [(140 + i, f"{prose(72000 + i, 40)}\n{passage} {prose(73000 + i, 40)}")]
        asked = " ".join(items[i % 5][1].split(" ")[5:5 + 7 + i])
        rows += [(160 + i, f"{prose(74000 + i, 40)} {asked} {prose(75000 + i, 40)}")]
    rows += [(200, "1 2 3 ..."), (201, "")]
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    def languages(rows):
        return {i: t for i, t in rows.items() if re.search(r"[^\W\d]", t)}

    def copies(rows):
        sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.lower().split()) for i, t in rows.items())}
        root = {i: i for i in rows}
        for a in sorted(rows):
            for b in sorted(rows):
                if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    old, new = max(root[a], root[b]), min(root[a], root[b])
                    root = {i: new if r == old else r for i, r in root.items()}
        return {i: t for i, t in rows.items() if root[i] == i}

    def passages(rows):
        out, some = {}, list(rows.items())
        for (i, t), (spans, gone) in zip(some, repeated_words(some), strict=True):
            raw, out[i], at = t.encode(), b"", 0
            for w in sorted(gone):  # the space between two words that go goes too
                out[i] += raw[at:spans[w][0]] if w - 1 not in gone else b""
                at = spans[w][1]
            out[i] = (out[i] + raw[at:]).decode()
        return out

    def benchmark(rows):
        windows = {tuple(w[j:j + 10]) for w in (plain_words(t) for _, t in items) for j in range(len(w) - 9)}
        return {i: t for i, t in rows.items() if not any(tuple(w[j:j + 10]) in windows for w in [plain_words(t)] for j in range(len(w) - 9))}

    want, lost = dict(rows), []
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], (languages, copies, passages, benchmark), strict=True):
        docs = common.stage(stage(spark, docs, str(tmp_path)), name)
        before, want = want, plain(want)
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == want, name
        assert docs.filter("n_chars <> length(text)").count() == 0 and docs.count() == len(want), name
        lost.append(sum(want.get(i) != t for i, t in before.items()))
    assert all(lost) and want[39] == next(t for i, t in rows if i == 39)


def test_pipeline_decides_by_row(spark, tmp_path):
    """Rows without doc_id, rows that share one, and rows that are there twice."""
    asked, other = prose(90001, 30), prose(90003, 30)
    spark.createDataFrame([(1, asked), (2, other)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    copy, own = prose(90002, 60), [prose(90010 + i, 60) for i in range(6)]
    rows = [(1, copy), (None, copy), (None, copy), (7, copy), (7, own[0]), (8, own[1]), (8, own[1]), (None, own[2]), (None, own[2] + " more")]
    rows += [(None, asked + " " + own[3]), (9, other + " " + own[4]), (9, own[5])]
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (s for _, s in corpus_pipeline.STAGES[:-1]):
        docs = common.stage(stage(spark, docs.repartition(3), str(tmp_path)), "next")
    got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    want = [(1, copy), (7, own[0]), (8, own[1]), (9, own[5])]
    assert [g for g in got if g[0] is not None] == want
    assert [g[1].removesuffix(" more") for g in got if g[0] is None] == [own[2]]


def test_pipeline_on_empty_tables(spark, tmp_path):
    docs = documents(spark, []).select(corpus_pipeline.COLUMNS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_row_numbers_are_those_of_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).write.parquet(path)
    one, two = (common.with_row(spark.read.parquet(path)) for _ in range(2))
    assert one.select("row").distinct().count() == 1000
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert one.join(two.withColumnRenamed("id", "other"), "row").filter("id <> other").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert common.with_row(spark.range(5).filter("id > 1")).count() == 3
