"""Operators over documents against brute force: the smallest table and a table of odd rows."""

import collections
import hashlib
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanstore.llm import jaccard_join, langid, line_dedup, mixing, packing, quality_rules, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def odd_texts():
    r = random.Random(5)
    base = " ".join(f"w{r.randrange(300)}" for _ in range(400))
    long_ = " ".join(f"v{r.randrange(5000)}" for _ in range(30_000))
    passage = "The same passage " + " ".join(f"p{i}" for i in range(70))
    near = base.split()
    near[50] = near[300] = "edited"
    return [
        None, "", " \n\t ", "one", "one two three four", "É é ß 日本語 K k", "a\x00b", "no letters 123 456", "123",
        base, base, " ".join(near), base.upper(), long_, long_ + " tail", passage, "x " + passage + " y", "ab" * 400, "a" * 199, "a" * 201,
        "same line\nother\nsame line\n same LINE \t", "\n\n", "<|endoftext|> don't stop's", "z" * 5000, "Same line\r\nlast",
    ] + ["shared line here\n" + str(i) for i in range(12)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ("en", "fr", None)[i % 3], (None, "a", "b", "é")[i % 4], i, "clash", 7) for i, t in enumerate(odd_texts())]
    rows.append((3, "one", "en", "a", 3, "clash", 7))  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string, size int")


@pytest.fixture(scope="module")
def real(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(params=["odd", "real", "empty"])
def docs(request, odd, real):
    return {"odd": odd, "real": real, "empty": odd.limit(0)}[request.param]


def pairs(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def counted(rows):
    return collections.Counter(rows)


def test_sharding(docs):
    got = sharding.shard_documents(docs).collect()
    sizes = counted((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in pairs(docs))
    assert counted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sizes
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], sharding.N_SHARDS) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_hash_is_even_and_moves_little():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 50_000).astype(np.uint64)
    a, b = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    assert set(b[a != b]) == {24} and abs((a != b).mean() - 1 / 25) < 0.005
    assert np.bincount(a).min() > 0.9 * 50_000 / 24


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup(docs, least):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    rows = pairs(docs)
    found = collections.Counter(k for _, t in rows for k in {key(s) for s in t.split("\n")} if k)
    expect = []
    for i, t in rows:
        ls = t.split("\n")
        kept = [s for s in ls if not (key(s) and found[key(s)] >= least)]
        expect.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    out = line_dedup.dedup_lines(docs.drop("_row"), least)
    assert counted((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == counted(expect)
    assert line_dedup.dedup_documents(docs).columns == docs.columns


def test_quality_statistics(docs):
    def repeated(ws):
        at = collections.defaultdict(list)
        for i in range(len(ws) - 7):
            at[tuple(ws[i : i + 8])].append(i)
        return len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)})

    expect = []
    for i, t in pairs(docs):
        ws, seen, dup = WORD.findall(t), set(), 0
        for s in t.split("\n"):
            if WORD.search(s):
                dup += s in seen
                seen.add(s)
        expect.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, repeated(ws)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality_rules.with_stats(docs).select("doc_id", *[f"_stats.{n}" for n in names]).collect()
    assert counted(tuple(r) for r in got) == counted(expect)


def test_rules_find_planted_conjunction():
    r = random.Random(3)
    rows = [{"a": r.random(), "b": r.random(), "c": r.random()} for _ in range(3000)]
    bad = [x["a"] > 0.7 and x["b"] <= 0.4 for x in rows]
    rules = quality_rules.learn_rules(rows, bad)
    hit = lambda x: any(all((x[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)
    assert rules and sum(hit(x) == b for x, b in zip(rows, bad)) > 2900
    assert quality_rules.learn_rules([], []) == [] and quality_rules.learn_rules(rows, [False] * 3000) == []


def test_quality_filter(spark, data, real):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    kept = quality_rules.filter_quality(real, labels)
    assert kept.columns == real.columns and 0 < kept.count() < real.count()
    assert quality_rules.filter_quality(real.limit(0), labels).count() == 0
    assert quality_rules.fit_rules(real, labels.limit(0)) == []


def test_mix(docs):
    got = mixing.mix(docs, F.col("doc_id"))
    sizes = got.sizes.collect()
    by_source = collections.Counter()
    for r in docs.select("source", "text").collect():
        by_source[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, brute_targets([by_source[s] for s in order])))
    takes = got.takes.groupBy("source_index", "start", "key").agg(F.sum("n_words").alias("n"), F.count_distinct("shard", "slot").alias("k")).collect()
    taken = {(r["source_index"], r["start"]): r["n"] for r in takes}
    total = collections.Counter()
    for r in sizes:
        n = taken.get((r["source_index"], r["start"]), 0) if r["size"] else 0
        assert n <= 2 * r["size"] and abs(r["target"] - target[r["source"]]) < 1e-6
        total[r["source"]] += n
    for s in order:
        assert abs(total[s] - target[s]) <= max(mixing.BLOCK, 0.05 * target[s])


def brute_targets(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    left, open_, out = 1.5 * sum(sizes), set(range(len(sizes))), {}
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * left / w >= 2 * sizes[i]]
        if not over:
            out |= {i: weights[i] * left / w for i in open_}
            break
        for i in over:
            out[i] = 2.0 * sizes[i]
        left -= sum(out[i] for i in over)
        open_ -= set(over)
    return [out[i] for i in range(len(sizes))]


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5).cast("long")).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_mixed_documents_hold_whole_words(real):
    out = mixing.mix_documents(real)
    assert out.columns == real.columns
    words = {r["doc_id"]: WORD.findall(r["text"] or "") for r in real.collect()}
    seen = collections.Counter()
    for r in out.collect():
        got = WORD.findall(r["text"])
        assert set(got) <= set(words[r["doc_id"]])
        seen[r["doc_id"]] += len(got)
    assert all(n <= 2 * len(words[i]) for i, n in seen.items())
    assert sum(seen.values()) == pytest.approx(1.5 * sum(map(len, words.values())), rel=0.02)


def test_packing(docs):
    tokenizer = packing._tokenizer(packing.public_tokenizer())
    expect = []
    for i, t in pairs(docs):
        ids = np.asarray(tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID], "<u4")
        expect += [(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(docs).collect()
    assert counted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == counted(expect)
    filled = collections.defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= packing.CAPACITY
    least = -(-sum(e[3] for e in expect) // packing.CAPACITY)
    assert len(filled) <= least + 3


def test_sum_of_squares_is_the_stated_choice():
    r = random.Random(2)
    sizes, cap = [r.randrange(1, 21) for _ in range(120)], 20
    which, _ = packing.sum_of_squares(np.asarray(sizes), cap)
    fill = collections.Counter()
    square = lambda f: sum(v * v for v in collections.Counter(cap - x for x in f.values() if x < cap).values())
    for s, b in zip(sizes, which.tolist()):
        options = [square({**fill, k: fill[k] + s}) for k in list(fill) if fill[k] + s <= cap] + [square({**fill, -1: s})]
        fill[b] += s
        assert square(fill) == min(options)


def test_language(real, odd):
    model = langid.train(real.filter(~langid.held_out(F.col("doc_id"))))
    out = langid.predict(real.select("doc_id", langid.held_out(F.col("doc_id")).alias("h"), "lang", "text"), model)
    held = out.filter("h and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    got = {r["doc_id"]: r for r in langid.predict(odd.select("doc_id", "text"), model).collect()}
    for i, t in pairs(odd):
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t)) and 0 <= got[i]["score"] <= 1
    none = langid.train(odd.limit(0))
    assert {r["lang_pred"] for r in langid.predict(odd.select("text"), none).collect()} == {"und"}


def brute_components(rows):
    sets = {}
    for i, t in rows:
        ws = WORD.findall(t.translate(ASCII_LOWER))
        sets[i] = frozenset(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else frozenset()
    label = {i: i for i in sets}
    while True:
        before = dict(label)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return {(i, len(sets[i]), label[i]) for i in sets}


def test_near_duplicates(docs):
    got = jaccard_join.link_documents(docs).collect()
    assert {tuple(r) for r in got} == brute_components(pairs(docs)) and len(got) == docs.count()
    kept = jaccard_join.dedup_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in got})


@pytest.mark.parametrize("tile", [1 << 20, 4000])
def test_family_in_one_tile_and_in_many(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "TILE_POINTS", 1 << 14 if tile > 4000 else 40)
    r = random.Random(8)
    base = [f"w{r.randrange(10**6)}" for _ in range(260)]

    def edited(k):
        ws = list(base)
        for _ in range(k):
            ws[r.randrange(len(ws))] = f"e{r.randrange(10**6)}"
        return " ".join(ws)

    rows = [(i, edited(r.choice((0, 1, 2, 4, 6, 9)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(x) for x in jaccard_join.link_documents(df).collect()} == brute_components(rows)


def test_tree_leaves_no_pair_out():
    r = np.random.default_rng(4)
    sets = []
    for _ in range(150):
        base = sets[r.integers(len(sets))] if sets and r.random() < 0.7 else r.integers(0, 1 << 62, r.integers(5, 60)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[r.random(len(base)) > 0.07], r.integers(0, 1 << 62, 2).astype(np.uint64)])))
    tree = jaccard_join.RTree(np.stack([jaccard_join.count_vector(s) for s in sets]), np.arange(150))
    left = [tuple(sorted((i, j))) for i, mates in tree.candidates() for j in mates.tolist()]
    assert len(left) == len(set(left))
    for i in range(150):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in left
    # Linked in one task, the roots are the components of brute force.
    pairs_ = [(i, j) for i in range(150) for j in range(i) if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - k)]
    whole = jaccard_join.Joined(np.arange(150))
    for i, j in pairs_:
        whole.join(i, j)
    assert jaccard_join.link_group(sets, np.arange(150)).tolist() == whole.roots().tolist() and len(set(whole.roots())) < 120


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 40, 3])
def test_suffix_dedup(docs, spark, monkeypatch, hot):
    """Also where most grams, or the surroundings of most, are hot."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = counted(tuple(r) for r in digest(docs).collect())
    rows = pairs(docs)
    windows = collections.Counter(b[p : p + 200] for _, t in rows for b in [t.encode()] for p in range(len(b) - 199))
    expect = []
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 199):
            if windows[b[p : p + 200]] > 1:
                gone[p] += 1
                gone[p + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expect.append((i, int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    assert got == counted(expect)


def digest(docs):
    rows, changed = suffix_dedup.remove_repeats(docs)
    c = changed.select("row", F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]).alias("n"), F.size("runs").alias("k"), F.sha2("kept", 256).alias("h"))
    return rows.join(c, "row", "left").select("id", F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0)), F.coalesce("h", F.sha2("text", 256)))


def test_suffix_dedup_keeps_no_repeat_whose_block_is_settled_elsewhere(spark):
    """Families B, C, A that share all from s on, where B and C also agree left of s and an anchor enters at s."""
    r = random.Random(11)
    text = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows = []
    while len(rows) < 90:
        shared = text(2000)
        x, lo, _, _ = suffix_dedup.anchors(np.frombuffer(shared.encode(), np.uint8))
        s = next((int(b) for a, b in zip(x, lo) if b > 600 and a == b + suffix_dedup.WINDOW - suffix_dedup.GRAM), None)
        if s is not None:
            edited = text(300) + ("#" if shared[s - 1] != "#" else "%") + shared[s:]
            rows += [(len(rows) + k, t) for k, t in enumerate((text(100) + shared, text(100) + shared, edited))]
    got = {x[0]: x[1] for x in digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    windows = collections.Counter(t[p : p + 200] for _, t in rows for p in range(len(t) - 199))
    for i, t in rows:
        gone = {q for p in range(len(t) - 199) if windows[t[p : p + 200]] > 1 for q in range(p, p + 200)}
        assert got[i] == len(gone)


def test_line_dedup_counts_a_repeated_document_once(spark, tmp_path):
    rows = [(1, "alone\nshared")] * 10 + [(i, f"shared\nown {i}") for i in range(2, 11)] + [(None, "null id")] * 10
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    kept = {1: "alone", None: "null id"} | {i: f"own {i}" for i in range(2, 11)}
    out = line_dedup.op5_line_dedup(spark, str(tmp_path)).collect()
    assert counted((r["doc_id"], r["kept_sha256"]) for r in out) == counted((i, hashlib.sha256(kept[i].encode()).hexdigest()) for i, _ in rows)
    docs = line_dedup.dedup_documents(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert counted((r["doc_id"], r["text"]) for r in docs.collect()) == counted((i, kept[i]) for i, _ in rows)


def test_word_memory_equals_the_tokenizer(tmp_path):
    r = random.Random(11)
    latin = "abcXYZ'stremlvd ÄäéÉßµªº²¼0189.,;:!?-_<|>\x1c\x1d\x1e\x1f\x85\xa0\n\t\x0b"
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 40))) for a in (latin, latin + "́ΣσςİıﬁЖж中文😀ẞ 　") for _ in range(2000)]
    texts += ["a<|endoftext|>b", "A<|ENDOFTEXT|>B", "don't 'single we're 12 x²", "\x1cabc\x1d d", *[t for t in odd_texts() if t]]
    words = packing.WordIds(packing.public_tokenizer(), limit=500)
    for text, ids in zip(texts, words.of(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    other = tmp_path / "other.json"
    other.write_text(pathlib.Path(packing.public_tokenizer("byte_bpe_50k.json")).read_text(encoding="utf-8"), encoding="utf-8")
    with pytest.raises(ValueError):
        packing.WordIds(str(other))
