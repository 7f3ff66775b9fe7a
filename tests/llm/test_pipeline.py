"""The pipeline against a plain version of every stage."""

from collections import Counter

import numpy as np
import pyarrow as pa

import corpus_pipeline
from test_passages import check_passages
from test_small_cases import brute_classes, brute_fingerprint, brute_hits, token_ids
from tidemark.llm import line_quality, substrings


def test_stages_against_plain_versions(spark, sf_dir, tmp_path):
    """Every stage on what its predecessor kept, and the whole run on the same pieces."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs, kept = read("documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r.text for r in docs.collect()})
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    scorer = line_quality.learn(read("documents"), read("labels"))
    assert kept[1] == {i: t for i, t in kept[0].items() if scorer(pa.array([t], pa.string()))[0] >= 0.5}
    ids, low = sorted(kept[1]), {}
    for i, c in zip(ids, brute_classes([brute_fingerprint(kept[1][i]) for i in ids])):
        low.setdefault(c, i)
    assert kept[2] == {i: kept[1][i] for i in low.values()}
    ranges = check_passages(spark.read.parquet(f"{tmp_path}/1"))
    cut = {i: substrings.without(t, ranges.get(i, [])) for i, t in kept[2].items()}
    assert kept[3] == {i: t for i, t in cut.items() if t == kept[2][i] or t.strip(" ")}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    clean = {i: t for i, t in kept[3].items() if not (hits := brute_hits(t, items))[1] or 20 * hits[1] < hits[0]}
    assert kept[4] == clean and len(clean) < len(kept[3])
    encode = token_ids("word_bpe_49k.json", 2)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    pieces, fill = {}, Counter()
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids))
        fill[r.sequence_id] += r.length
    assert set(pieces) == set(clean)
    for i, parts in pieces.items():
        ids = np.concatenate([np.frombuffer(x[2], "<u4") for x in sorted(parts)])
        assert ids.tolist() == encode(clean[i])
    assert max(fill.values()) <= 4096 and sum(fill.values()) / (4096 * len(fill)) > 0.95
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in docs.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in got)


def test_near_dedup_goes_by_row(spark, sf_dir):
    same, other = "a b c d e f g h. " * 5, "Quite another text about something else. " * 3
    rows = [(1, same), (1, same), (2, same), (None, same), (None, same), (None, other), (5, "x"), (5, same)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [(1, same), (None, other), (5, "x")])) and out.columns == docs.columns
    nulls = spark.createDataFrame([(None, same, "en", "s", 1)] * 3, docs.schema)
    assert corpus_pipeline.near_dedup(spark, nulls, sf_dir).count() == 1


def test_pipeline_on_an_empty_table(spark, sf_dir, tmp_path):
    for t in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_take_odd_rows(spark, sf_dir, tmp_path):
    """Null and empty texts, repeated rows, a null id, an extra column; every stage writes and reads."""
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    fine = "This is a line of text that says something. And one more line says something else.\nIt ends here, at last."
    odd = [(0, fine, "en", "a", 10, 1), (0, fine, "en", "a", 10, 1), (None, fine + " No id.", "en", "a", 10, 2), (3, None, "en", "b", None, 3), (4, "", None, None, 0, 4)]
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("*", corpus_pipeline.F.lit(7).alias("_score"))
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, _score int").unionByName(base)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    texts = spark.read.parquet(f"{tmp_path}/3")
    assert texts.where("doc_id is null").count() <= 1
