"""Bin completion: the search against exhaustive packing, the operator against plain encoding."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bin_completion
from tidemark.llm.tokens import public_path


def optimum(items, capacity):
    """Fewest bins, by trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, [*rooms[:j], rooms[j] - items[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def check(packing, items, capacity):
    got = Counter()
    for bins, filling in packing:
        assert sum(x * n for x, n in filling) <= capacity
        for x, n in filling:
            got[x] += bins * n
    assert got == Counter(items)
    return sum(bins for bins, _ in packing)


def test_search_is_optimal_on_small_cases():
    rnd, better = random.Random(1), 0
    for t in range(400):
        capacity = rnd.choice([10, 20, 50, 100])
        low, high = (1, capacity) if t % 2 else (capacity // 5 + 1, capacity // 2 + 1)
        items = [rnd.randint(low, high) for _ in range(rnd.randint(1, 11))]
        counts = dict(Counter(items))
        bins, fit = check(bin_completion.complete(counts, capacity), items, capacity), check(bin_completion.best_fit(counts, capacity), items, capacity)
        best = optimum(items, capacity)
        assert bin_completion.lower_bound(counts, capacity) <= best == bins <= fit
        better += bins < fit
    assert better > 3  # best fit alone would not do


def test_search_on_many_lengths():
    lengths = np.random.default_rng(0).integers(800, 1800, 600).tolist()
    counts = dict(Counter(lengths))
    bins = check(bin_completion.complete(counts, 4096), lengths, 4096)
    assert bins < check(bin_completion.best_fit(counts, 4096), lengths, 4096)
    assert bin_completion.complete({}, 4096) == []


def test_dominance():
    # 3 and 4 can give place to a free 7, or 4 to a free 5 where room is left
    assert bin_completion.dominated(((4, 1), (3, 1)), 7, 1 << 7)
    assert bin_completion.dominated(((4, 1), (3, 1)), 8, 1 << 5)
    assert not bin_completion.dominated(((4, 1), (3, 1)), 7, 1 << 5 | 1 << 4 | 1 << 3)


def packed(spark, rows, schema="doc_id long, text string", capacity=64):
    out = bin_completion.pack(spark.createDataFrame(rows, schema), public_path("word_bpe_49k.json"), "space", 1, capacity)
    return out.toPandas().sort_values(["doc_id", "piece"])


def test_pieces(spark):
    tokenizer = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    rnd = random.Random(5)
    texts = [None, "", "A word.", "x" * 500] + [" ".join(rnd.choice(["alpha", "Beta,", "naïve", "数"]) for _ in range(rnd.randint(1, 90))) for _ in range(60)]
    got = packed(spark, list(enumerate(texts)))
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = got[got.doc_id == i]
        assert own.piece.tolist() == list(range(-(-len(ids) // 64)))
        assert own.start.tolist() == list(range(0, len(ids), 64))
        for r in own.itertuples():
            part = np.array(ids[r.start : r.start + 64], "<u4").tobytes()
            assert (r.length, r.ids_crc32, r.ids) == (len(part) // 4, crc32(part), part)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        ends = own.offset + own.length
        assert own.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 64
    counts = got.length.value_counts().to_dict()
    assert got.sequence_id.nunique() == check(bin_completion.complete(counts, 64), got.length.tolist(), 64)


def test_repeats_clashes_and_empty(spark):
    rows = [(7, "one two", "a", 1), (7, "one two", "b", 2), (None, "three", "c", 3)]
    got = packed(spark, rows, "doc_id long, text string, sequence_id string, _number int")
    assert len(got) == 3 and got.sequence_id.nunique() == 1
    assert len(packed(spark, [])) == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 128, 4097])
def test_whole(n):
    parts = bin_completion.whole(n, 64)
    assert sum(parts) == n and all(p == 64 for p in parts[:-1])
