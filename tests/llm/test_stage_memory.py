"""Memory and disk of the pipeline's stages: no second set of Python workers, small blocks, tables given back, packed copies."""

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from coldflow.llm import huffman, mixing, queries, text, workers


def test_mix_starts_no_rdd_workers(spark, docs, no_docs, monkeypatch):
    def none(*args, **kwargs):
        raise AssertionError("rows of the driver go through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", none)
    got = queries.mixed(docs).select("source_size", "target", "taken").collect()
    assert len(got) == docs.count() and sum(r["taken"] for r in got) > 0
    assert queries.mixed(no_docs).count() == 0
    assert mixing.FLOWS.names == ["sources", "copies", "rest", "source_size", "target"]


class _Rows:
    """Stands for the documents: gives the function that a worker runs."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


@pytest.mark.usefixtures("spark")
def test_encoding_a_batch_holds_small_blocks():
    run = huffman.encode_ids(_Rows(), queries.vocabulary())
    texts = [" ".join(f"word{(i * 31 + k) % 997}" for k in range(300)) for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    assert batch.nbytes > 6 << 20
    first = [b for b in run(iter([batch]))]  # builds the encoder
    text.forget_powers()
    tracemalloc.start()
    n = 0
    for b in run(iter([batch])):
        n += b.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == sum(b.num_rows for b in first) == len(texts) + 1
    assert peak < 64 << 20  # with blocks of 2 MB more than 100


def test_a_new_owner_gives_back_the_power_tables():
    workers.cache("one")
    data = np.arange(1 << 16, dtype=np.uint64).astype(np.uint8)
    before = text.span_hashes(data, np.array([5]), np.array([900]))
    assert len(text._powers[0]) > 1 << 16
    workers.cache("two")
    assert len(text._powers[0]) == 1
    assert text.span_hashes(data, np.array([5]), np.array([900])) == before


def test_numbered_copies_are_packed(spark, docs):
    rows = corpus_pipeline._numbered(docs, "test")
    assert rows.drop(corpus_pipeline.ROW).exceptAll(docs).isEmpty() and rows.count() == docs.count()
    assert rows.select(F.countDistinct(corpus_pipeline.ROW)).first()[0] == docs.count()
    assert all(".zstd." in f for f in rows.inputFiles())
