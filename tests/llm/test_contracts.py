"""The columns of the registered queries without SQL, each recomputed plainly over the whole table."""

import zlib

import numpy as np
import pytest

from test_small_cases import brute_base, brute_classes, brute_fingerprint, brute_shard, token_ids
from tidemark.llm import shards
from tidemark.llm.entries import QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_query(spark, sf_dir, texts):
    encode = token_ids("word_bpe_49k.json", 2)
    got = QUERIES["op1_harmonic_packing"](spark, sf_dir).toPandas()
    for doc, part in got.sort_values("start").groupby("doc_id"):
        ids, at = encode(texts[doc]), 0
        for r in part.itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    assert set(got.doc_id) == set(texts)
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 4096


def test_token_file_query(spark, sf_dir, texts):
    encode, at = token_ids("byte_bpe_50k.json", 0), 0
    got = QUERIES["op4_arrow_token_files"](spark, sf_dir).toPandas().sort_values("doc_id")
    for r, doc in zip(got.itertuples(), sorted(texts), strict=True):
        ids = encode(texts[doc])
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), crc(ids))
        at += len(ids)


def test_shard_query(spark, sf_dir, texts):
    got = QUERIES["op6_weighted_hash_tree"](spark, sf_dir).toPandas()
    for r in got.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (brute_shard(shards.tree(24), r.doc_id), brute_shard(shards.tree(25), r.doc_id))
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in got.groupby("shard")) and len(got) == len(texts)


def test_rule_query(spark, sf_dir, texts):
    got = QUERIES["op7_ngram_ratio_rules"](spark, sf_dir).toPandas()
    # the threshold is the rule's: one in a hundred trusted rows with words lies under it, to a thousandth
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    trusted = np.sort(got[got.doc_id.isin(good)].ratio.dropna())
    at = np.floor(trusted[int(0.01 * len(trusted))] * 1000) / 1000
    for r in got.itertuples():
        base = brute_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0]) and r.kept == (not r.base_failed and r.ratio >= at)
    assert len(got) == len(texts)


def test_simhash_query(spark, sf_dir, texts):
    got = QUERIES["op8_simhash_near_dedup"](spark, sf_dir).toPandas().set_index("doc_id")
    ids = sorted(texts)
    fps = [brute_fingerprint(texts[i]) for i in ids]
    low = {}
    for i, c in zip(ids, brute_classes(fps)):
        low.setdefault(c, i)
    want = [low[c] for c in brute_classes(fps)]
    assert [got.fingerprint[i] for i in ids] == [f"{f:016x}" for f in fps] and [got.component_id[i] for i in ids] == want and len(got) == len(ids)


def test_quality_and_span_queries(spark, sf_dir, texts):
    got = QUERIES["op9_line_field_quality"](spark, sf_dir).toPandas()
    assert len(got) == len(texts) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.itertuples())
    cut = QUERIES["op2_sentence_span_dedup"](spark, sf_dir).toPandas()
    assert len(cut) == len(texts) and all(r.removed_bytes == len(texts[r.doc_id].encode()) - len(r.text.encode()) for r in cut.itertuples())
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    text = QUERIES["op3_block_field_text"](spark, sf_dir).toPandas()
    assert len(text) == pages and (text.n_chars == text.text.str.len()).all()
