"""Few candidates are scored where the postings are read; a recall list is merged in one shuffle of the hits."""

import re

from coldflow.operators import posting_store, recall
from tests.conftest import rows


def test_few_candidates_leave_the_postings_in_place(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(str(i), f"red gear{'' if i % 3 else ' old'}", f"B{i % 4}", i) for i in range(300)], "item_id string, name string, singer string, fire int")
    store = recall.build_store(docs, str(tmp_path / "store"))
    asked = spark.createDataFrame([("gear red",), ("old gear",), ("none",)], "q string")
    plain = rows(recall.open_catalogue(spark, store).name.match(asked, "q", 3, prune=False))
    seen, scores = [], posting_store.FieldIndex.scores

    def spy(self, *args):
        found = scores(self, *args)
        seen.append("Exchange hashpartitioning(bucket" in found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(posting_store.FieldIndex, "scores", spy)
    assert rows(recall.open_catalogue(spark, store).name.match(asked, "q", 3)) == plain and len(plain) == 6
    assert seen == [True, False]  # the probe's, the candidates'
    seen.clear()
    monkeypatch.setattr(posting_store, "SMALL_PAIRS", 0)
    assert rows(recall.open_catalogue(spark, store).name.match(asked, "q", 3)) == plain
    assert seen == [True, True]


def test_merge_shuffles_hits_once(spark):
    hit = "event_id long, pos int, item_id string, fire int, score double, rank int"
    wf = recall.Waterfall(None, None, 1, 5)
    wf.name = spark.createDataFrame([(1, 0, "a", 3, 1.0, 1), (2, 0, "a", 3, 1.0, 1)], hit)
    wf.singer = spark.createDataFrame([(1, 1, "a", 3, 1.0, 1), (1, 1, "b", 9, 0.5, 2), (None, 0, "c", 1, 1.0, 1)], hit)
    songs = spark.createDataFrame([(1, "u"), (1, "u"), (2, "v")], "event_id long, uid string")
    merged = recall.merge_recalls(wf, songs)
    assert rows(merged) == [(1, "u", "a", 3, "name", 1), (1, "u", "b", 9, "singer", 2), (2, "v", "a", 3, "name", 1)]
    plan = recall.merge_recalls(wf, songs)._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert not [x for x in shuffles if "item_id" in x] and len(shuffles) == 3, plan  # the hits'; two of the songs'
