"""Tables of earlier stages go."""

import os

import corpus_pipeline
from coldflow.session import scratch_path


def test_tables_of_earlier_stages_go(spark, monkeypatch):
    left = {}

    def stage(name):
        def run(spark, docs, sf_dir):
            left[name] = scratch_path(spark, f"work-{name}")
            docs.write.parquet(left[name])
            return spark.read.parquet(left[name])

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("one"), stage("two"), stage("three")])
    monkeypatch.setattr(corpus_pipeline.queries, "table", lambda spark, sf_dir, name: spark.range(9).withColumnRenamed("id", "doc_id"))
    assert corpus_pipeline.run(spark, "").count() == 9
    assert [os.path.exists(left[n].removeprefix("file:")) for n in ("one", "two", "three")] == [False, False, True]
