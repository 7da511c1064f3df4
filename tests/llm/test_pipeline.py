"""The stages, each against plain Python on its own input."""

import numpy as np
from test_dedup import groups_of, lines_kept

import corpus_pipeline
from trolley.llm import decontamination, quality, queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = queries.read(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        result = stage(spark, docs, SF_DIR)
        path = str(tmp_path / name)
        result.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "sentencepiece":
            assert after.columns == docs.columns
        rows = after.collect()
        if name == "quality_classifier":
            ratio = quality.fit(docs, queries.read(spark, SF_DIR, "labels"))
            kept = {r.doc_id for r in quality.resample(docs, ratio).where("selected").collect()}
            assert {r.doc_id for r in rows} == kept and len(kept) < len(before)
        elif name == "line_dedup":
            expected = {(i, text) for i, _, _, text in lines_kept(before)}
            assert {(r.doc_id, r.text) for r in rows} == expected
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_duplicates":
            expected = {i for i, size, component in groups_of(before, 5, 80) if size == 0 or i == component}
            assert {r.doc_id for r in rows} == expected
        elif name == "decontamination":
            hits = decontamination.contaminations(docs, queries.read(spark, SF_DIR, "benchmark"))
            clean = hits.where(~decontamination.is_contaminated())
            assert {r.doc_id for r in rows} == {r.doc_id for r in clean.collect()}
        else:
            texts = dict(before)
            assert {r.doc_id: r.decoded for r in rows} == texts
            assert all(r.n_tokens == len(r.ids) and r.ids[-1] == 2 for r in rows)
        docs = after
    assert 0 < docs.count() < 200


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_duplicates", "decontamination", "sentencepiece",
    ]
    result = corpus_pipeline.run(spark, SF_DIR)
    assert set(result.columns) == {"doc_id", "n_tokens", "ids", "decoded"}
    assert np.all([r.n_tokens > 0 for r in result.collect()])
