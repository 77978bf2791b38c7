"""Later rounds of the first fit hold few rows."""

import random

from coldflow.llm import mixing
from coldflow.session import stage_table
from pyspark.sql import functions as F


def _rows(spark, n, rest):
    draw = random.Random(3)
    docs = [(f"d{i}", ["a"] if i % 2 else ["b", None], draw.randint(0, 60), f"{draw.getrandbits(128):032x}", i, rest) for i in range(n)]
    return docs, spark.createDataFrame(docs, "id string, sources array<string>, size long, h string, row long, rest long").withColumn("bin", F.substring("h", 1, 3))


def test_first_fit_equals_a_loop_and_later_rounds_hold_few_rows(spark, monkeypatch):
    staged = {}

    def stage(df, name):
        out = stage_table(df, name)
        staged.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(mixing, "stage_table", stage)
    for rest in (0, 1, 777, 4000, 10**6):
        docs, frame = _rows(spark, 400, rest)
        want, room = set(), {}
        for d in sorted(docs, key=lambda d: (d[3], d[2], d[0], d[4])):
            left = room.setdefault(tuple(d[1]), rest)
            if 0 < d[2] <= left:
                want.add(d[4])
                room[tuple(d[1])] = left - d[2]
        staged.clear()
        found = mixing._first_fit(frame)
        assert {r["row"] for r in found.where("picked").collect()} == want and found.count() == 400
        assert set(staged) <= {"mix-cuts", "mix-left", "mix-more"} and sum(staged.get("mix-left", [])) < 400
