"""The five stages, each against what its operator says of the same input."""

import corpus_pipeline
from archivelens.llm import language, mixing, neardup, quality, storage

from .test_operators import brute_classes


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "quality rules", "near-dedup", "mixing", "packing"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == columns
        ids = sorted(r["doc_id"] for r in out.select("doc_id").collect())
        if name == "language ID":
            want = [r["doc_id"] for r in language.identify(docs).filter("not rejected").collect()]
        elif name == "quality rules":
            want = [r["doc_id"] for r in quality.quality(docs).filter("kept").collect()]
        elif name == "near-dedup":
            rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
            want = [rows[k][0] for k in set(brute_classes([t for _, t in rows]))]
            assert neardup.classes(out).filter("doc_id <> class_id").count() == 0
        elif name == "mixing":
            want = [r["doc_id"] for r in mixing.mix(docs).collect() for _ in range(r["copies"])]
        else:
            assert set(ids) == {r["doc_id"] for r in docs.collect()}
            break
        assert ids == sorted(want)
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_odd_rows_go_through(odd, none, spark, sf):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf).count()


def test_stages_free_the_driver(spark, sf, monkeypatch):
    """pipeline: plans and generated classes of one stage, or of one pass of mixing, don't stay in the driver with the next."""
    freed = []
    for module in (corpus_pipeline, mixing):
        monkeypatch.setattr(module, "tidy", lambda s, m=module: freed.append(m.__name__))
    corpus_pipeline.run(spark, sf)
    assert freed.count("corpus_pipeline") == len(corpus_pipeline.STAGES) and freed.count(mixing.__name__) == mixing.PASSES


def test_plans_of_mixing_stay_small(spark, sf):
    """pipeline: ranks aren't written out again at every use, which made code that didn't compile and a gigabyte of garbage in the driver."""
    plan = mixing.mixed_documents(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") <= 2


def test_kept_tables_free_the_driver(spark, monkeypatch):
    """pipeline: what a query left in the driver goes before the next, also within a stage."""
    freed = []
    monkeypatch.setattr(storage, "tidy", freed.append)
    assert storage.keep(spark.range(3), "three").count() == 3 and freed == [spark]
