"""Hand cases of FIXTURES.md 1.1 and 1.2 (log line and song parsing)."""

from pyspark.sql import functions as F

from coldflow.operators import parse
from tests.conftest import rows

SEP = "\x1f"


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value string")


def test_log_line_cases(spark):
    values = [
        f"uid~1{SEP}audios~[]",
        f"audios~[]{SEP}uid~1{SEP}x~y",
        f"uid~1~2{SEP}audios~[]",
        f"uid~1{SEP}uid~2{SEP}audios~[]",
        f"uid~1{SEP}uid~{SEP}audios~[]",
        f"uid~{SEP}audios~[]",
        f"uid{SEP}audios~[]",
        "",
        None,
    ]
    out = parse.parse_log(_lines(spark, values))
    got = {r["event_id"]: (r["uid"], r["audios"], r["reason"]) for r in out.collect()}
    assert got[0] == ("1", "[]", None)
    assert got[1] == ("1", "[]", None)
    assert got[2] == ("1", "[]", None)
    assert got[3] == ("2", "[]", None)
    assert got[4] == ("1", "[]", None)
    for i in (5, 6, 7, 8):
        assert got[i][2] == "incomplete"


def _songs(spark, audios, mode="faithful"):
    recs = spark.createDataFrame([(i, "u", a) for i, a in enumerate(audios)], "event_id long, uid string, audios string")
    parsed = parse.parse_songs(recs)
    ok, bad = parse.split(parsed)
    songs = parse.with_singers(parse.song_rows(ok), mode)
    return songs, bad


def test_song_cases(spark):
    audios = [
        '[{"d_filename":"f","d_singername":"刘德华","d_songname":"s"}]',
        '[{"d_songname":"s"}]',
        '[{"d_singername":"A、B"}]',
        '[{"d_singername":"A_B"}]',
        '[{"d_singername":"A-B"}]',
        '[{"d_singername":"Taylor Swift"}]',
        '[{"d_singername":" "}]',
        '[{"d_singername":"","d_songname":""}]',
        "[{}]",
        "[]",
        '[{"d_songname":7}]',
    ]
    songs, bad = _songs(spark, audios)
    assert bad.count() == 0
    got = {r["event_id"]: (r["song_name"], list(r["singers"])) for r in songs.collect()}
    assert got[0] == ("s", ["刘德华"])
    assert got[1] == ("s", [""])
    assert got[2] == ("", ["A", "B"])
    assert got[3] == ("", ["A", "B"])
    assert got[4] == ("", ["A-B"])
    assert got[5][1][0] == "T"
    assert got[6] == ("", [""])
    assert 7 not in got and 8 not in got and 9 not in got
    assert got[10] == ("7", [""])
    lit, _ = _songs(spark, ['[{"d_singername":"Taylor Swift"}]'], mode="literal")
    assert lit.collect()[0]["first_singer"] == "Taylor Swift"


def test_song_rejects(spark):
    _, bad = _songs(spark, ['[{"d_songname":null}]', "oops", '{"d_songname":"s"}', "[5]"])
    got = dict(rows(bad, "event_id", "reason"))
    assert got == {0: "null_field", 1: "bad_json", 2: "bad_json", 3: "bad_json"}


def test_accepted_plus_rejected_is_input(spark):
    """Property: every line is either accepted or rejected, never both."""
    import hypothesis.strategies as st
    from hypothesis import given, settings

    alphabet = st.sampled_from(["uid", "audios", "~", SEP, "1", "", "x", "[]"])

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.lists(alphabet, max_size=8).map("".join), min_size=1, max_size=20))
    def check(values):
        out = parse.parse_log(_lines(spark, values))
        ok, bad = parse.split(out)
        assert ok.count() + bad.count() == len(values)

    check()


def test_java_trim(spark):
    from coldflow.functions.text import java_trim

    df = spark.createDataFrame([("\t\n a b \x01",)], "s string")
    assert df.select(java_trim(F.col("s")).alias("t")).collect()[0]["t"] == "a b"
