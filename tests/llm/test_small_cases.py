"""Nulls, empty and odd texts, repeated rows, clashing names and empty tables for every operator."""

import html.parser
import math
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import arrow_files, chat, contamination, flat, html_text, line_quality, ngram_rules, packing, shards, simhash, substrings
from tidemark.llm.tokens import TextEncoder, public_path

LONG = " ".join(f"wörd{i % 977}" for i in range(30_000)) + "."
ODD = [
    (1, "The cat sat. On the mat!\nYes it did so."), (2, None), (3, ""), (4, "   \n\t "), (5, LONG), (6, LONG), (6, LONG),
    (None, "no id here at all, none"), (7, "a  b\n\nc \u3000d <|endoftext|>"), (8, "***"), (9, "The cat sat. On the mat!\nYes it did so."),
]
SCHEMA = "doc_id long, text string, _doc_ double, h long, ranges string, fp string, `range` string, ids string, trusted int"


def rows(spark, data=ODD):
    return spark.createDataFrame([(i, t, 0.0, 1, "x", "y", "z", "w", 1) for i, t in data], SCHEMA)


def token_ids(name, end):
    """Ids by the plain library, with the one setting that the files' README names: special strings are ordinary text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", "space"), ("byte_bpe_50k.json", "gpt")])
def test_pieces_encode_as_the_whole(name, cut):
    e, plain = TextEncoder(public_path(name), cut), token_ids(name, 0)
    odd = ["", " ", "\n", "a  b", " x", "x ", "a\tb c", "it's ok don't", "ΑΣ ΑΣΑ", "İ, x", "e ́ x", "a\x1cb c", "<|endoftext|> a", "日本 語。\n x", "x²! É&&&", "A.B.", "a''s", "Don't.'s", "\na b\nc", "K. k", LONG]
    for text in odd + [t for _, t in ODD if t]:
        want = np.array(plain(text)[:-1], "<u4").tobytes()
        assert e(text) == want
        assert e(text) == want


def test_packing(spark):
    encode = token_ids("word_bpe_49k.json", 2)
    got = packing.pack(rows(spark), public_path("word_bpe_49k.json"), "space", 2).toPandas()
    want = Counter((None if i is None else i, tuple(encode(t))) for i, t in ODD)
    by_doc = {}
    for r in got.itertuples():
        part = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(part) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc.setdefault(None if np.isnan(r.doc_id) else int(r.doc_id), set()).add((r.start, part, r.doc_tokens))
    for doc, ids in want:
        at = 0
        for start, part, total in sorted(x for x in by_doc[doc] if x[2] == len(ids)):
            assert start == at and part == ids[at : at + len(part)]
            at += len(part)
        assert at == len(ids)
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 4096
    assert sum(got.length) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(rows(spark, []), public_path("word_bpe_49k.json"), "space", 2).count() == 0


def test_packing_pads_little():
    rng = np.random.default_rng(3)
    for n in rng.integers(1, 40_000, 200).tolist():
        parts = packing.cuts(n, 4096)
        assert sum(parts) == n and max(parts) <= 4096
        assert all(4096 - 4096 // p * p <= 64 for p in parts)
    pieces = [(p, 0, 4096 // p - 1) for p in (2048, 1365, 63, 5, 1) if 4096 // p > 1]
    placed = packing.shared_bins(pieces, 4096, 10)
    fill = Counter()
    for length, _, b, at in sorted(placed, key=lambda x: (x[2], x[3])):
        assert at == fill[b]
        fill[b] += length
    assert max(fill.values()) <= 4096 and len(placed) == sum(n for _, _, n in pieces)


def test_arrow_files(spark, tmp_path):
    encode = token_ids("byte_bpe_50k.json", 0)
    folder = str(tmp_path / "files")
    manifest = arrow_files.write(rows(spark), folder, public_path("byte_bpe_50k.json"), "gpt", 0, length=64, shards=3)
    got = arrow_files.read(spark, folder, manifest).toPandas().sort_values("start")
    at = 0
    for r in got.itertuples():
        ids = [encode(t) for i, t in ODD if i == r.doc_id or (i is None and np.isnan(r.doc_id))]
        assert r.start == at and (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids]
        at += r.n_tokens
    assert len(got) == len(ODD) and got.doc_id.dropna().is_monotonic_increasing
    shard = arrow_files.Shard(folder, manifest.first()["name"])
    ids, mask = shard.batch(0)
    assert len(ids) == len(mask) and len(ids) % 64 == 0 and not ids.flags.owndata
    for r in manifest.collect():
        shard = arrow_files.Shard(folder, r.name)
        flow = np.concatenate(list(shard.stream()))
        for i in range(len(shard)):
            ids, mask = shard.sequence(i)
            assert not ids.flags.owndata and ids[: mask.true_count].tolist() == flow[64 * i : 64 * i + 64].tolist() and len(ids) == 64
        with pytest.raises(IndexError):
            shard.sequence(len(shard))
    empty = arrow_files.write(rows(spark, []), folder + "2", public_path("byte_bpe_50k.json"), "gpt", 0)
    assert arrow_files.read(spark, folder + "2", empty).count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(fps):
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    data = ODD + [(i + 100, t) for i, t in docs.itertuples(index=False)]
    got = simhash.near_duplicates(rows(spark, data)).collect()
    want = [brute_fingerprint(t) for _, t in data]
    assert Counter(r.fp & (2**64 - 1) for r in got) == Counter(want)
    low = {}
    for (i, _), c in zip(data, brute_classes(want)):
        low[c] = min((x for x in (low.get(c), i) if x is not None), default=None)
    expected = Counter((i, low[c]) for (i, _), c in zip(data, brute_classes(want)))
    assert Counter((r.doc_id, r.component_id) for r in got) == expected
    assert simhash.near_duplicates(rows(spark, [])).count() == 0


def test_bit_planes_find_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64).tolist()
    fps = sorted({b ^ sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(0, 5)))) for b in base for _ in range(6)})
    links = simhash.run_links(np.array(fps, np.uint64), 3)
    up = list(range(len(fps)))
    for i, j in links:
        assert (fps[i] ^ fps[j]).bit_count() <= 3
    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in links:
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == brute_classes(fps)
    dealt = simhash._parts(np.array(fps, np.uint64), 3)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    assert all(any(i in g and j in g for g in map(set, dealt)) for i, j in near)


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, names = set(), set()
    for name, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        n = min(13, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize(("set_bytes", "piece"), [(1 << 24, 1 << 16), (100, 1 << 16), (700, 5), (3000, 1)])
def test_contamination(spark, set_bytes, piece):
    """One set and several, items of more windows than a piece, a piece over a set."""
    items = [(1, "The CAT sat, on the mat"), (2, None), (3, "..."), (10, " ".join(f"wörd{i}" for i in range(40, 60))), (10, "yes"), (4, "the mat yes it did so " * 3), (12, " ".join(f"wörd{i}" for i in range(100, 160))), (12, " ".join(f"wörd{i}" for i in range(100, 160)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    data = ODD + [(50, "Say the mat, yes it did so. The mat yes it did so the mat! End"), (51, "wörd39 " + " ".join(f"WöRD{i}" for i in range(45, 70)))]
    got = contamination.find(rows(spark, data), bench, set_bytes=set_bytes, piece=piece).select("doc_id", "text", "contamination.*").collect()
    assert len(got) == len(data)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == brute_hits(r.text, items)
    kept = contamination.decontaminate(rows(spark, data), bench, remove="spans")
    assert kept.columns == rows(spark).columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[50].startswith("Say ") and texts[50].endswith("! End") and "mat" not in texts[50] and texts[2] is None
    assert contamination.find(rows(spark, []), bench).count() == 0
    assert contamination.find(rows(spark), bench.limit(0)).where("contamination.n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        contamination.find(rows(spark), bench, into="ranges")


def test_shards(spark):
    tree = shards.tree(24)
    data = [(i, f"t{i % 7}") for i in range(3000)] + [(None, "n"), (5, "t5"), (5, "t5")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("_bucket", shards.F.lit("mine")).withColumn("grown", shards.shard_of(shards.tree(25), shards.F.col("doc_id")))
    got = shards.assign(df, tree, "doc_id", ["text"], bucket_rows=500).toPandas()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert len(got) == len(data) and set(got.shard) == set(range(24)) and set(got._bucket) == {"mine"}
    moved = got[got.shard != got.grown]
    assert set(moved.grown) == {24} and 60 < len(moved) < 200
    assert got.groupby("doc_id").shard.nunique().max() == 1
    assert got.shard.value_counts().between(70, 190).all()
    heavy = shards.Tree(((((0, 3.0), (1, 1.0)),), (((2, 4.0),),)))
    share = df.select(shards.shard_of(heavy, shards.F.col("doc_id")).alias("s")).groupBy("s").count().toPandas().set_index("s")["count"]
    assert 1000 < share[0] < 1250 and 300 < share[1] < 450 and 1380 < share[2] < 1620
    assert shards.assign(df.limit(0), tree, "doc_id", []).count() == 0


def signed(x):
    return x - (1 << 64 if x >> 63 else 0)


def brute_shard(tree, key):
    """The descent with plain hashes: of each level the child of the smallest -ln(u) / weight."""

    def draw(node, weight):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        bits = xxhash.xxh64_intdigest(node.encode(), seed) >> 11
        return -math.log((bits + 0.5) / 2.0**53) / weight

    total = lambda rack: sum(w for _, w in rack)
    r, region = min(enumerate(tree.regions), key=lambda x: draw(f"region {x[0]}", sum(map(total, x[1]))))
    k, rack = min(enumerate(region), key=lambda x: draw(f"rack {r}.{x[0]}", total(x[1]))) if len(region) > 1 else (0, region[0])
    return min(rack, key=lambda x: draw(f"shard {x[0]}", x[1]))[0]


def test_shards_are_the_plain_descent_and_move_inside_changed_subtrees(spark):
    keys = [*range(-5, 4000), None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    even, key = shards.tree(24), shards.F.col("k")
    change = lambda s, w: 2.5 if s == 9 else w  # noqa: E731 - shard 9: second region, first rack
    heavy = shards.Tree(tuple(tuple(tuple((s, change(s, w)) for s, w in rack) for rack in region) for region in even.regions))
    got = df.select("k", shards.shard_of(even, key).alias("a"), shards.shard_of(heavy, key).alias("b"), shards.shard_of(shards.tree(25), key).alias("c")).collect()
    for r in got:
        assert (r.a, r.b, r.c) == tuple(brute_shard(t, r.k) for t in (even, heavy, shards.tree(25)))
    region, rack = (lambda s: s // 8), (lambda s: s // 4)
    moved = [r for r in got if r.a != r.b]
    assert moved and all(region(r.b) == 1 for r in moved) and any(region(r.a) != 1 for r in moved)
    assert all(rack(r.b) == 2 for r in moved if region(r.a) == 1) and all(r.b == 9 for r in moved if rack(r.a) == 2)
    assert {r.c for r in got if r.a != r.c} == {24}
    for n in (1, 3, 8, 11, 24, 27):
        assert sorted(s for reg in shards.tree(n).regions for rk in reg for s, _ in rk) == list(range(n))


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {k for i, g in enumerate(grams) if g in often for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def brute_ratio(text, weight, n):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    total = 0.0
    for a, b in zip(words, [*words[1:], None]):
        h = xxhash.xxh64_intdigest(a, 42)
        total += weight[(h - (1 << 64 if h >> 63 else 0)) % n]
        if b is not None:
            h = xxhash.xxh64_intdigest(b, h)
            total += weight[(h - (1 << 64 if h >> 63 else 0)) % n]
    return total / (2 * len(words) - 1) if words else None


@pytest.mark.parametrize("place_bits", [20, 58, 3])
def test_ngram_rules(spark, sf_dir, monkeypatch, place_bits):
    # many place bits leave few for the hash, few make places overflow: the exact way must take over
    monkeypatch.setattr(ngram_rules, "PLACE_BITS", place_bits)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    data = ODD + [(20, "a b c a b c a b c d"), (21, "x x x x x\nx\n\nx\n #<>|")] + [(i + 100, t) for i, t in docs.itertuples(index=False)][:80]
    df = rows(spark, data)
    trusted = spark.createDataFrame([(i,) for i in range(100, 140)] + [(100,), (None,)], "doc_id long")
    got = ngram_rules.judge(df, trusted, 42, buckets=512, at=-0.05).collect()
    weight = ngram_rules.weights(ngram_rules.bucket_counts(df, trusted, 42, 512), 512)
    want = Counter()
    for i, t in data:
        base = brute_base(t)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        half = xxhash.xxh64_intdigest(b"fold", xxhash.xxh64_intdigest((t or "").encode(), 42)) & 1
        r = brute_ratio(t, weight[half], 512)
        want[(i, *base, failed, not failed and r >= -0.05)] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")) for r in got) == want
    assert ngram_rules.judge(rows(spark, []), trusted, 42, buckets=64).count() == 0
    # the other fold's trusted texts are all that a weight knows
    kept = Counter()
    for i, t in data:
        if i in set(range(100, 140)):
            words = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
            half = xxhash.xxh64_intdigest(b"fold", xxhash.xxh64_intdigest((t or "").encode(), 42)) & 1
            kept[half] += max(0, 2 * len(words) - 1)
    counts = ngram_rules.bucket_counts(df, trusted, 42, 512).agg({"target_0": "sum", "target_1": "sum"}).first()
    assert {counts["sum(target_0)"], counts["sum(target_1)"]} == {kept[0], kept[1]} and counts["sum(target_0)"] == kept[0]


def test_ngram_verdict_can_be_filtered_and_ignores_the_own_label(spark, sf_dir):

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = labels.where("quality = 1")
    judged = ngram_rules.judge(docs, good, good.count())
    began = time.perf_counter()
    whole = judged.collect()
    took = time.perf_counter() - began
    began = time.perf_counter()
    assert judged.where("kept and not base_failed").count() == sum(r.kept for r in whole)
    assert time.perf_counter() - began < 2 * took + 5
    # a row's ratio is the same whether the row itself is trusted or not
    one = good.orderBy("doc_id").first().doc_id
    with_, without = (ngram_rules.judge(docs, t, 1, buckets=4096, at=0.0).where(F.col("doc_id") == one).first().ratio for t in (good, good.where(F.col("doc_id") != one)))
    assert with_ == without


def test_ngram_threshold_loses_its_share(spark):
    texts = spark.createDataFrame([(f"w{i} w{i + 1} w{i % 7}",) for i in range(300)] + [(None,), ("",)], "text string")
    weight = ngram_rules.weights(ngram_rules.bucket_counts(texts.selectExpr("1 as doc_id", "text"), texts.selectExpr("1 as doc_id").limit(1), 1, 64), 64)
    ratios = sorted(r[0] for r in ngram_rules.with_words(texts.selectExpr("1 as doc_id", "text")).withColumn("fold", ngram_rules.fold()).select(ngram_rules.ratio(weight)).where("size(words) > 0").collect())
    for lost in (0.0, 0.1, 0.5):
        at = ngram_rules.threshold(texts, weight, lost)
        assert at <= ratios[int(lost * 300)] < at + 0.001 + 1e-12
    assert ngram_rules.threshold(texts.limit(0), weight) == 0.0


def test_chat(spark):
    data = [
        (1, 0, "user", "Hi <|im_end|> \\ <\\p"), (1, 1, "assistant", "<|im_start|>assistant\nok\\"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "tail"),
        (2, 0, None, "x"), (3, 1, "assistant", "second"), (3, 0, "assistant", "first"), (3, 1, "assistant", "second"), (None, 0, "a\n\\n<|", "\n\n"), (4, None, "assistant", "long " * 5000),
    ]
    df = spark.createDataFrame([(*d, 1, "z") for d in data], "conv_id long, turn long, role string, text string, example int, segment string")
    found = chat.examples(df)
    back = {r.conv_id: r for r in chat.read_back(found).collect()}
    for conv in {d[0] for d in data}:
        turns = sorted((d[1] is not None, d[1] or 0, d[2] or "", d[3] or "") for d in data if d[0] == conv)
        assert [(t.role, t.text) for t in back[conv].turns] == [t[2:] for t in turns]
        assert back[conv].losses == [t[3] for t in turns if t[2] == "assistant"]
    rows_of = [r for r in found.collect() if r.conv_id == 1]
    assert [r.example for r in sorted(rows_of, key=lambda r: r.example)] == [0, 1, 2] and [r.last for r in sorted(rows_of, key=lambda r: r.example)] == [False, False, True]
    texts = {r.example: r for r in rows_of}
    for k in (0, 1):
        mask = texts[k].text[texts[k].loss_start : texts[k].loss_end]
        assert mask == [chr(60) + "\\pim_start|>assistant\nok\\\\", ""][k] and texts[k].text.startswith("<|im_start|>user\nHi ") and texts[k].text.endswith("<|im_end|>\n")
        assert texts[k + 1].text.startswith(texts[k].text) and texts[k].text.count("<|im_start|>") == 2 * k + 2
    assert texts[2].loss_start is None and texts[2].text.count("<|im_start|>") == 5
    assert chat.examples(df.limit(0)).count() == 0 and chat.read_back(chat.examples(df.limit(0))).count() == 0
    # turns without a conversation are conversations by themselves
    none = spark.createDataFrame([(None, 0, "assistant", "a"), (None, 0, "assistant", "a"), (None, 1, "user", "b")], "conv_id long, turn long, role string, text string")
    assert sorted((r.turns[0].text, r.losses) for r in chat.read_back(chat.examples(none)).collect()) == [("a", ["a"]), ("a", ["a"]), ("b", [])]


def doc_order(doc, text):
    return doc is not None, doc or 0, signed(xxhash.xxh64_intdigest((text or "").encode(), 42))


def brute_spans(rows, sentences, min_words, long_word):
    """Byte ranges to remove from every row ``(doc, text)``, in the rows' order; the words themselves are the keys."""
    first, later, seen = {}, [[] for _ in rows], set()
    order = sorted(range(len(rows)), key=lambda k: (*doc_order(*rows[k]), k))
    for key in order:
        raw = (rows[key][1] or "").encode()
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        ends = [i for i, (s, e) in enumerate(words) if i + 1 == len(words) or raw[e - 1 : e] in b".!?" or e - s >= long_word or b"\n" in raw[e : words[i + 1][0]]]
        starts = [0, *[e + 1 for e in ends[:-1]]]
        for u, s in enumerate(starts):
            for v in range(u + sentences - 1, len(ends)):
                if ends[v] + 1 - s >= min_words:
                    gram = tuple(raw[a:b] for a, b in words[s : ends[v] + 1])
                    if first.setdefault(gram, key) != key or (gram, key) in seen:
                        later[key].append((words[s][0], words[ends[v]][1]))
                    seen.add((gram, key))
                    break
    return later


def test_span_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    passage = "Here is a passage of some words. It goes on and on, for more than fifty words in all. " * 1 + "Then it says one thing more about the weather tomorrow! And another thing about nothing at all, which is fine. The end of it comes with this very last sentence, extraordinarily."
    data = ODD + [(None, passage + " In one without id."), (None, passage + " In another one."), (8, passage), (8, passage), (8, passage + " More of it.")]
    data += [(60, "Start of mine " + passage + " and so on it goes"), (61, passage), (62, "Other words\n" + passage + "\nlast line")]
    data += [(i + 100, t) for i, t in docs.itertuples(index=False)]
    got = substrings.dedup_spans(rows(spark, data), removed="gone").collect()
    later = brute_spans(data, substrings.SENTENCES, substrings.MIN_WORDS, substrings.LONG_WORD)
    want = Counter((i, None if t is None else substrings.without(t, sorted(r))) for (i, t), r in zip(data, later))
    assert Counter((r.doc_id, r.text) for r in got) == want
    texts = {r.doc_id: r.text for r in got}
    assert {(r._doc_, r.ranges, r.range) for r in got} == {(0.0, "x", "z")}
    assert "another thing about" not in texts[60] + texts[61] + texts[62] and texts[62].startswith("Other words")
    assert sum("another thing about" in (r.text or "") for r in got) == 1
    assert substrings.dedup_spans(rows(spark, [])).count() == 0
    assert substrings.without("a b\nc d\ne", [(0, 3)]) == "c d\ne" and substrings.without("a bb c", [(2, 4)]) == "a c"


def test_line_quality(spark):
    good = [f"This is line {i} of a fine text, with words in it.\nAnd here is more of it." for i in range(40)]
    bad = ["BUY!! NOW!! " * 8 + "\n***$$$%%% ###" for _ in range(40)]
    data = [(i, t) for i, t in enumerate([x for p in zip(good, bad) for x in p])]
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(80)], "doc_id long, quality int")
    scorer = line_quality.learn(rows(spark, data), labels)
    got = {r.doc_id: r.score for r in line_quality.score(rows(spark, data), scorer).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 0) for i, _ in data)
    odd = line_quality.score(rows(spark), scorer).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd) and {*rows(spark).columns, "score"} == set(odd[0].asDict())
    assert line_quality.score(rows(spark, []), scorer).count() == 0
    none = line_quality.learn(rows(spark, data), labels.limit(0))
    assert {r.score for r in line_quality.score(rows(spark), none).collect()} == {0.5}
    held = rows(spark, data).select("doc_id", line_quality.held_out(line_quality.F.col("doc_id")).alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)


def test_line_quality_learns_from_rows_that_fit(spark):
    """A text over the limit is skipped, wherever it stands; rows that share an id give one text."""
    fine = [(i, "This is a fine text, of words. " * 3 if i % 2 else "BUY!! NOW!! $$$ " * 3) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1)], "doc_id long, quality int")
    for long in ["x" * 5000, "\n" * 3000]:
        data = fine + [(i, long) for i in range(80, 200)] + [(3, fine[3][1])] * 50 + [(None, "no id")]
        scorer = line_quality.learn(rows(spark, data), labels, max_bytes=64_000, max_lines=16_000)
        assert scorer.model is not None
        got = {r.doc_id: r.score for r in line_quality.score(rows(spark, data), scorer).collect()}
        assert all((got[i] >= 0.5) == (i % 2 == 1) for i, _ in fine)


def test_line_quality_of_many_lines():
    """Blocks of lines give the score of the whole; a million blank lines take seconds."""
    import pyarrow as pa

    good = [f"This is line {i} of a fine text, with words in it.\nAnd here is more of it." for i in range(40)]
    bad = ["BUY!! NOW!! " * 8 + "\n***$$$%%% ###" for _ in range(40)]
    scorer = line_quality.Scorer.learn(good + bad, [1] * 40 + [0] * 40)
    mixed = "\n".join(x for p in zip(good, bad) for x in p)
    column = pa.array(["", "\n", "\n\n\n", "a\nb", mixed, "x" * 1000, None, "\n" * 77, mixed + "\n", LONG])
    whole = scorer(column)
    for block in (1, 2, 7, 100):
        assert np.allclose(scorer(column, block), whole, atol=1e-12)
    began = time.perf_counter()
    assert 0 <= scorer(pa.array(["\n" * 1_000_000]))[0] <= 1
    assert time.perf_counter() - began < 30


def test_line_quality_on_rows_never_learned_from(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    scored = line_quality.score(docs.select("doc_id", "text"), line_quality.learn(docs, labels)).join(labels, "doc_id")
    held = scored.where(line_quality.held_out(line_quality.F.col("doc_id"))).select("score", "quality").toPandas()
    right = ((held.score >= 0.5) == (held.quality == 1)).mean()
    assert len(held) > 50 and right > 0.97 and right > held.quality.mean() + 0.05


def test_ngram_threshold_on_rows_left_out(spark):
    """The trusted rows are one part of the labelled ones; the threshold is judged on the other."""
    big = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    part = line_quality.held_out(line_quality.F.col("doc_id"))
    trusted = labels.where(~part & (line_quality.F.col("quality") == 1))
    got = ngram_rules.judge(docs.repartition(8), trusted, trusted.count()).join(labels.where(part), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert len(good) > 500 and good[~good.base_failed].kept.mean() > 0.98 and bad.kept.mean() < 0.02


def test_line_features_agree_with_single_rows():
    import pyarrow as pa

    texts = ["a b\n\nCC!! 1", "", "x\n", "é" * 40, LONG]
    x, size, per_row = line_quality.line_features(*flat.bytes_of(pa.array(texts)))
    alone = [line_quality.line_features(*flat.bytes_of(pa.array([t]))) for t in texts]
    assert np.allclose(x, np.vstack([a[0] for a in alone])) and per_row.tolist() == [3, 1, 2, 1, 1]


def test_chain_against_all_label_sequences():
    from itertools import product

    from tidemark.llm import crf

    rng = np.random.default_rng(2)
    lengths, trans = np.array([3, 1, 4]), rng.normal(size=(2, 2))
    unary = rng.normal(size=(8, 2))
    marginals, expected, log_z = crf.forward_backward(unary, trans, lengths)
    best, at, want_z, want_e = crf.viterbi(unary, trans, lengths), 0, 0.0, np.zeros((2, 2))
    for n in lengths:
        scores = {y: sum(unary[at + i, y[i]] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])) for y in product((0, 1), repeat=int(n))}
        z = np.log(sum(np.exp(list(scores.values()))))
        want_z += z
        for i in range(n):
            assert np.isclose(marginals[at + i, 1], sum(np.exp(s - z) for y, s in scores.items() if y[i]))
        for y, s in scores.items():
            for a, b in zip(y, y[1:]):
                want_e[a, b] += np.exp(s - z)
        assert tuple(best[at : at + n]) == max(scores, key=scores.get)
        at += n
    assert np.isclose(log_z, want_z) and np.allclose(expected, want_e)


class Article(html.parser.HTMLParser):
    """The text inside ``article`` by the standard library's parser, block by block."""

    INLINE = set("a abbr b bdi cite code del em font i ins kbd mark q s small span strong sub sup time u var wbr br img input".split())

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.raw, self.out, self.held = 0, 0, [], []
        self.feed(page or "")
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.held).split())
        self.out += [text] if text else []
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag not in self.INLINE:
            self.flush()
        self.held += [" "] if tag == "br" else []
        self.depth += tag == "article"
        self.raw += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.flush()
        self.depth -= tag == "article"
        self.raw -= tag in ("script", "style")

    def handle_data(self, data):
        if self.depth and not self.raw:
            self.held.append(data)


def test_html(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = html_text.main_text(pages).toPandas()
    for r in got.itertuples():
        assert r.text == "\n".join(Article(r.html).out)
    odd = [(1, None), (2, ""), (3, "<p>a &am"), (4, "<div class='nav"), (5, "<" * 50), (6, "<p>" * 2000 + "x"), (7, '<article><p>One &lt;two&gt; three\u00a0 four &#233;.</p><script>var x = "<p>no</p>"</script><p>Five <b>six</b>.</p></article>'), (7, "<p title=\"a>b\">ok then</p>")]
    df = spark.createDataFrame([(i, "u", h, "t") for i, h in odd], "page_id long, url string, html string, text string")
    out = html_text.main_text(df.unionByName(pages.select("page_id", "url", "html", html_text.F.lit("t").alias("text")))).where("url = 'u'").collect()
    texts = {}
    for r in out:
        texts.setdefault(r.page_id, []).append(r.text)
    assert texts[1] == texts[2] == [""] and len(out) == len(odd)
    assert "One <two> three four é.\nFive six." in texts[7]
    assert html_text.main_text(df.limit(0)).count() == 0


def test_html_of_deep_pages_takes_linear_time():
    began = time.perf_counter()
    assert len(html_text.blocks("<div>x" * 20_000 + "</section>" * 20_000 + "</span>" * 20_000)) == 20_000
    assert time.perf_counter() - began < 5
    deep = html_text.blocks("<article class='post'><div>" * 3 + "in" + "</div></article>" * 2 + "less" + "</div></article>" + "out")
    assert [(b.text, sorted(b.tags), bool(b.inner)) for b in deep] == [("in", ["article"], True), ("less", ["article"], True), ("out", [], False)]
    assert [b.text for b in html_text.blocks("<p>a<script src=x />no</script>b<svg/>c</p>")] == ["abc"]


def test_html_leaves_out_what_is_not_the_article():
    pages = []
    model = html_text.train(pages)
    page = (
        "<body><header><a href='/'>Home</a></header><div class='cookie-banner'>We use cookies.</div><main><div class='article-body'><h1>A title</h1>"
        "<p>Some text that is<br>long enough, yes.</p><p>A second paragraph of text that goes on.</p><div class='ad-slot'>Buy this now</div><p>A third one.</p></div></main>"
        "<aside>Related things.</aside><div class='comments'><p>Great article, thanks for sharing it with us all.</p></div><form><label>Name</label></form><footer>&copy; me</footer></body>"
    )
    assert html_text.extract_texts(model, [page]) == ["A title\nSome text that is long enough, yes.\nA second paragraph of text that goes on.\nA third one."]


def test_components(spark):
    from tidemark.llm.common import components

    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (200, 203), (203, 201), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 201: 200, 203: 200}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    from tidemark.llm import common

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    count = lambda: sum("shuffle_" in f for f in str(files()).split(","))
    setting, held = spark.conf.get(common._CLEANUP), spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert held.repartition(3).collect() and count() > 0  # files of others stay
    before = count()
    back = common.stash(held.repartition(5), "counts")
    assert count() <= before and spark.conf.get(common._CLEANUP) == setting
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, held.collect()))
