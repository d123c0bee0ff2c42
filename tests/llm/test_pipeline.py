import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from rowtide.llm import decontam, packing, pii, quality_rules, simhash  # noqa: E402
from rowtide.llm.io import scratch  # noqa: E402


def test_stages_apply_their_decisions(spark, documents, odd_rows):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    clean = lambda n: " ".join(word() for _ in range(n))
    item = f"{clean(20)}. {clean(6)}."
    rows, labels = [], []
    for i in range(150):
        text = clean(60)
        bad = i % 5 == 0
        rows.append((100 + i, " ".join(w + "###" for w in text.split()) if bad else text))
        labels.append((100 + i, int(not bad)))
    copy = clean(60)
    rows += [(500, copy), (501, copy), (502, clean(30) + " " + item), (503, clean(30) + " me@mail1.example " + clean(30))] + odd_rows
    docs = documents(rows)
    root = scratch(spark, "pipeline-test")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    seen = spark.read.parquet(f"{root}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, root)
        assert seen.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in seen.collect()}
    good = {i for i, y in labels if y}
    assert good | {500, 501, 502, 503} <= set(kept["quality rules"]) and not {i for i, y in labels if not y} & set(kept["quality rules"])
    assert set(kept["quality rules"]) - set(kept["SimHash near-dedup"]) >= {501} and 500 in kept["SimHash near-dedup"]
    assert set(kept["SimHash near-dedup"]) - set(kept["benchmark decontamination"]) == {502}
    assert "<EMAIL>" in kept["personal data"][503]
    pieces = corpus_pipeline.run(spark, root).collect()
    assert {r.doc_id for r in pieces} == set(kept["personal data"])
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert all((decontam, packing, pii, quality_rules, simhash))
