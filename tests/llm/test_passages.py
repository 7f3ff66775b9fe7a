"""Repeated passages of 50 words and more go whole, wherever they begin."""

import random

from tidemark.llm import substrings


def test_passages_of_short_words_go_whole(spark):
    deal = random.Random(7)
    word = lambda: "".join(deal.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    words = lambda n: [word() for _ in range(n)]
    data, planted = [], []
    for k in range(40):
        passage = words(51 + k % 3 * 40)
        if k % 2:
            passage[16] += "."
            passage[29] += "."
        planted.append(" ".join(passage))
        for copy in range(2 + k % 2):
            data.append((1000 * copy + k, " ".join([*words(60 + k), planted[-1], *words(70 - k)])))
    short = " ".join(words(49))
    data += [(5000, " ".join([*words(80), short, *words(80)])), (5001, " ".join([*words(80), short, *words(80)]))]
    twice = " ".join(words(60))
    data += [(5002, " ".join([twice, *words(30), twice]))]
    texts = {i: t for i, t in data}
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in substrings.dedup_spans(docs, run=substrings.RUN).collect()}
    for i, t in texts.items():
        if 1000 <= i < 5000:
            before, after = t.split(planted[i % 1000])
            assert got[i] == before + after.lstrip()
        elif i == 5002:
            assert got[i] == t[: -len(twice)]
        else:
            assert got[i] == t


def check_passages(docs):
    """By brute force: no run of 50 words that an earlier document has keeps a word; nothing new goes that no earlier text has.  The ranges by id."""
    docs = docs.select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ranges = {r._doc: substrings.passages(texts[r._doc], r.ranges, substrings.RUN) for r in substrings.repeats(docs, run=substrings.RUN).collect()}
    spans = {r._doc: substrings.passages(texts[r._doc], r.ranges, None) for r in substrings.repeats(docs).collect()}
    seen, long_seen, runs = set(), set(), 0
    for i in sorted(texts):
        raw = texts[i].encode()
        words = raw.split()
        place, at = [], 0
        for w in words:
            at = raw.index(w, at)
            place.append((at, at + len(w)))
            at += len(w)
        gone = lambda k, of: any(a <= place[k][0] and place[k][1] <= b for a, b in of.get(i, []))
        grams = [tuple(words[k : k + 26]) for k in range(len(words) - 25)]
        longs = [tuple(words[k : k + 50]) for k in range(len(words) - 49)]
        must, may, own = set(), set(), set()
        for k, g in enumerate(grams):
            if g in seen or g in own:
                may.update(range(k, k + 26))
            own.add(g)
        for k, g in enumerate(longs):
            if g in long_seen:
                must.update(range(k, k + 50))
        runs += bool(must)
        seen.update(grams)
        long_seen.update(longs)
        if i in ranges or must:
            assert all(gone(k, ranges) for k in must), i
            assert all(k in may or gone(k, spans) for k in range(len(words)) if gone(k, ranges)), i
    assert runs > 5
    return ranges


def test_passages_of_documents_go_whole(spark, sf_dir):
    check_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    deal = random.Random(9)
    words = lambda n: " ".join("".join(deal.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(n))
    passage = words(60)
    texts = [f"{words(30)} {passage} {words(30)}" for _ in range(4)]
    data = [(None, texts[0]), (None, texts[1]), (3, texts[2]), (3, texts[3]), (3, texts[3]), (None, texts[1]), (7, "x y z"), (7, "x y z"), (8, None), (8, None)]
    got = substrings.dedup_spans(spark.createDataFrame(data, "doc_id long, text string").repartition(4), removed="gone", run=substrings.RUN).collect()
    assert len(got) == len(data) and sum(passage in (r.text or "") for r in got) == 1
    assert sum(r.text == "" for r in got) == 2 and sum(r.text == "x y z" for r in got) == 2 and sum(r.text is None for r in got) == 2


def test_spans_are_whole_sentences(spark, sf_dir):
    """Every range begins at the first word of a sentence and ends at the last word of one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = substrings.repeats(docs).collect()
    assert len(found) > 5
    for r in found:
        raw = texts[r._doc].encode()
        for start, end in substrings.passages(texts[r._doc], r.ranges, None):
            before, after = raw[:start], raw[end:]
            assert not before.split() or before.rstrip()[-1:] in b".!?" or b"\n" in before[len(before.rstrip()) :]
            assert not after.split() or raw[end - 1 : end] in b".!?" or b"\n" in after[: len(after) - len(after.lstrip())]


def test_long_words_end_sentences_if_asked(spark):
    shared = "some extraordinary words of one two three four five unquestionably six seven eight nine ten interchangeable eleven twelve"
    data = [(1, f"begin {shared} end"), (2, f"other start {shared} and other end"), (3, "nothing shared here")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = lambda **how: {r.doc_id: r.text for r in substrings.dedup_spans(docs, **how).collect()}
    assert got() == dict(data)
    cut = got(long_word=9, sentences=2, min_words=10)
    assert cut[1] == data[0][1] and cut[3] == data[2][1] and cut[2] == "other start some extraordinary eleven twelve and other end"
