import difflib
import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions import text as X
from loomspark.operators import review as R

HARD = ["a \n b", "　", "「(x)」", "(a)(b)", "…………", "ﬁ ㎏", "Straße", "", "abcabcabcabcabcabcabc", " \x1c x \x85", "「『（a）』」", "a..b...c", "♥●？！", "～—x", "\t[n]x"]


def applied(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_transcript_whitespace(spark):
    def plain(t):
        t = unicodedata.normalize("NFC", t).strip()
        return re.sub(r"\n+", " ", re.sub(r"[ \t\r\f\v]+", " ", t)).strip()

    got = applied(spark, HARD, X.normalize_transcript(F.col("t")))
    assert [g[0] for g in got] == [plain(t) for t in HARD]
    assert got[0][0] == "a   b"


def test_normalize_text_order(spark):
    got = dict(zip(HARD, [g[0] for g in applied(spark, HARD, X.normalize_text(F.col("t")))]))
    assert got["「(x)」"] == "x"
    assert got["(a)(b)"] == "(a)(b)"
    assert got["…………"] == "……"
    assert got["「『（a）』」"] == "a"
    assert got["a..b...c"] == "a…b…c"
    assert got["♥●？！"] == "♡○?!"
    assert got["\t[n]x"] == "x"
    assert got["～—x"] == "ーx"


@settings(max_examples=200, deadline=None)
@given(st.text("「」()（）a", max_size=12))
def test_peeling_keeps_what_no_pair_encloses(text):
    out = X.peel_brackets(text)
    assert out in text
    assert X.peel_brackets(out) == out


def test_compact_folds_case(spark):
    assert applied(spark, ["Straße!", "Ａ b"], X.compact("t")) == [("strasse",), ("ab",)]


def test_similarity_is_ordered(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide")], "a string, b string")
    got = [r[0] for r in df.select(X.similarity("a", "b")).collect()]
    assert got == [difflib.SequenceMatcher(None, "tide", "diet").ratio(), difflib.SequenceMatcher(None, "diet", "tide").ratio()]
    assert got[0] != got[1]


def test_sanitizers(spark):
    long = "x" * 120
    values = ["a b/c:d", "..", None, "日本 語", long]
    got = [g[0] for g in applied(spark, values, X.sanitize_id(F.col("t"), "none"))]
    assert got[:4] == ["a_b-c-d", hashlib.sha1(b"..").hexdigest()[:16], "none", "日本_語"]
    assert got[4] == "x" * 80 + "-" + hashlib.sha1(long.encode()).hexdigest()[:10]
    assert applied(spark, ["a -- b"], X.sanitize_component(F.col("t"), "f", 8)) == [("a_b",)]


def test_density_bounds(spark):
    df = spark.createDataFrame([("x" * 19, 100.0), ("x" * 20, 100.0), ("x" * 200, 10.0), ("x" * 201, 10.0), ("", 10.0), ("abc", None)], "t string, s double")
    got = [r[0] for r in df.select(R.transcript_reasons(F.col("t"), F.col("s"))).collect()]
    assert "text_too_sparse" in got[0] and "text_too_sparse" not in got[1]
    assert "text_too_dense" not in got[2] and "text_too_dense" in got[3]
    assert got[4] == ["empty_transcript"]
    assert got[5] == []


@pytest.mark.parametrize(("text", "flag"), [("ab" * 6, True), ("ab" * 5, False), ("a b a b a b a b a b a b", True)])
def test_repeated_unit(spark, text, flag):
    assert ("repeated_transcript" in applied(spark, [text], R.transcript_reasons(F.col("t")))[0][0]) is flag


def test_json_in_text(spark):
    values = ['{"a":1}', 'x ```json\n{"a":2}\n``` y', 'see {"a":3} there', "none"]
    assert [g[0] for g in applied(spark, values, F.get_json_object(X.json_from_text(F.col("t")), "$.a"))] == ["1", "2", "3", None]


def test_clip_id_rounds_half_to_even(spark):
    df = spark.createDataFrame([("s", 0.0005, 0.0015)], "s string, a double, b double")
    assert df.select(X.clip_id(F.col("s"), F.col("a"), F.col("b"), "_nv")).first()[0] == "s_nv_0000000000_0000000002"
