"""The pipeline: five stages, each on all its predecessor kept."""
import collections
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_stages_in_order(spark):
    import corpus_pipeline as p
    from cabflow.llm import minhash, mixing, pii
    from cabflow.llm.common import stored
    assert [n for n, _ in p.STAGES] == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, kept = docs.columns, {}
    for name, stage in p.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == cols
        kept[name] = docs
        if name == "language_id":
            # clean documents stay: every text with letters in a known language
            assert docs.count() == before.where(r"text rlike '\\p{L}'").count()
        if name == "near_dedup":
            classes = minhash.near_duplicates(before)
            assert {r.doc_id for r in docs.collect()} == {r.class_id for r in classes.collect()}
        if name == "pii":
            assert docs.count() == before.count()
            texts = {r.doc_id: r.text for r in before.collect()}
            for r in docs.collect():
                assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
                if not pii.base_spans(texts[r.doc_id]):
                    assert r.text == texts[r.doc_id]
    words = kept["mixing"].select(F.sum(mixing.word_count("text"))).first()[0]
    assert abs(words - kept["pii"].select(F.sum(mixing.word_count("text"))).first()[0]) <= 20
    packed = p.STAGES[-1][1](spark, docs, SF)
    rows = packed.collect()
    assert collections.Counter(r.doc_id for r in rows if r.start == 0) == collections.Counter(r.doc_id for r in docs.collect())
    assert p.run(spark, SF).count() == len(rows)
