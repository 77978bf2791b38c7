"""Property tests against small Python models."""

import hypothesis.strategies as st
from hypothesis import given, settings

from coldflow.operators import keyed, parse
from tests.conftest import rows

OPS = st.lists(
    st.tuples(
        st.sampled_from(["k1", "k2"]),
        st.sampled_from(["a", "b", "c", None]),
        st.integers(0, 9),
        st.sampled_from(["replace", "put", "delete"]),
    ),
    min_size=1,
    max_size=12,
)


def _model(ops):
    """Apply ops in version order; a replace version groups all its rows."""
    state = {}
    by_version = {}
    for version, (key, member, score, op) in enumerate(ops):
        by_version.setdefault(version, []).append((key, member, score, op))
    for version in sorted(by_version):
        for key, member, score, op in by_version[version]:
            if op in ("replace", "delete"):
                state[key] = {}
            if member is not None and op != "delete":
                state.setdefault(key, {})[member] = float(score)
    return sorted((k, m, s) for k, d in state.items() for m, s in d.items())


def test_zset_view_equals_model(spark):
    schema = "key string, member string, score double, op string, version long"

    @settings(max_examples=12, deadline=None)
    @given(OPS)
    def check(ops):
        # a delete carries no member
        ops = [(k, None if op == "delete" else m, s, op) for k, m, s, op in ops]
        df = spark.createDataFrame(
            [(k, m, float(s), op, v) for v, (k, m, s, op) in enumerate(ops)], schema
        )
        assert rows(keyed.zset_view(df), "key", "member", "score") == _model(ops)

    check()


def test_binary_payload_never_throws(spark):
    """Bad UTF-8 bytes are cast, not decoded, and end up rejected or parsed - never an error."""
    data = [(0, bytearray(b"uid~1\x1faudios~[]")), (1, bytearray(b"uid~\xff\xfe\x1faudios~[]")), (2, bytearray(b"\xff"))]
    df = spark.createDataFrame(data, "event_id long, value binary")
    got = {r["event_id"]: r["reason"] for r in parse.parse_log(df).collect()}
    assert got[0] is None and got[2] == "incomplete"
    assert 1 in got
