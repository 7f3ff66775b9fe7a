"""Phrases from the word graph against counting everything."""

import random
import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, first):
    """Everything counted in one dictionary."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    heavy = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    inside = Counter()
    for (lang, w), a in heavy.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in heavy.items():
        if inside[lang, w] < a:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:first])
    }


def rows_of(frame):
    return {tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.mark.parametrize("bits", [4, 16])
def test_against_counting(spark, bits, monkeypatch):
    monkeypatch.setattr(collocations, "PLACES", 50)
    monkeypatch.setattr(collocations, "WORDS", 8)
    monkeypatch.setattr(collocations, "SLICE", 40)
    rnd = random.Random(2)
    words = ["a", "B", "été", "of", "the", "x-y", "数字", "rare%d"]
    rows = [(None, None), ("en", ""), ("en", " \t "), ("de", "...;;\n\r"), ("fr", "w" * 300 + " the the")]
    for i in range(150):
        text = "".join(rnd.choice(words).replace("%d", str(rnd.randint(0, 400))) + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".\n"]) for _ in range(rnd.randint(1, 60)))
        rows.append((rnd.choice(["en", "de", None]), text))
    rows += [("en", "A License Line of the x-y kind, as is")] * 40
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "lang string, text string, n string, size int").repartition(3)
    for first in (5, 1000):
        got = rows_of(collocations.collocations(docs, 12, first, bits))
        assert got == plain(rows, 12, first)
    assert any(" " in p[2] and len(p[2].split()) == 5 for p in got)


def test_rare_pairs_end_a_gram_but_words_count(spark):
    rows = [("en", "u v w%d u v" % i) for i in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(collocations.collocations(docs, 30, 10)) == plain(rows, 30, 10) == {("en", 1, "u v", 60, 60, 60, 150, 2500)}


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string"), 2).count() == 0


def test_sql_at_a_lower_threshold(spark, sf_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = db.execute(collocations.OP13_SQL.replace("f >= 100", "f >= 20")).fetchall()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(collocations.collocations(docs, 20)) == set(want) and len(want) > 50
