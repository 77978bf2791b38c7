import pytest

from coldflow.llm.workers import importable

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. " * 12),
    (1, "THE quick brown fox jumps over the lazy dog. " * 12),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "one two three"),
    (6, "One two  three"),
    (7, "été déjà vu\nnaïve  façade — 日本語 テキスト\n\nend " + " ".join(f"w{i}" for i in range(40))),
    (8, " ".join(f"w{i}" for i in range(40)) + " tail of this one"),
    (9, " ".join(f"v{i % 7}" for i in range(3000))),
    (9, " ".join(f"v{i % 7}" for i in range(3000))),
    (10, " ".join(f"u{i}" for i in range(400))),
    (11, " ".join(f"u{i}" for i in range(390)) + " x y z"),
    (12, "word joined   spaces\x1c here"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, copies, and columns whose names operators use inside."""
    importable(spark)
    rows = [(i, t, "en" if i % 2 else "fr", None if i == 5 else f"s{i % 3}", 1, 0.5, "x", 7) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, copies long, score double, uid string, part int")


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return docs.where("false")
