"""The executors' heaps between the pipeline's stages."""

import corpus_pipeline
from kindred.llm import suffix_dedup


def collections(spark) -> int:
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_a_stage_begins_with_collected_heaps(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "remove_repeats", lambda docs: docs)
    before = collections(spark)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert corpus_pipeline.cut_repeats(spark, docs, "") is docs and collections(spark) > before
