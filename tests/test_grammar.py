"""Text → number grammar against Python's float()/int() (Z13), as a property."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tripspark.functions import parse

DIGITS = st.text(alphabet="0123456789", min_size=1, max_size=6)
NUMERIC = st.one_of(
    st.builds(lambda s, a, b: f"{s}{a}.{b}", st.sampled_from(["", "+", "-"]), DIGITS, DIGITS),
    st.builds(lambda s, a: f"{s}{a}", st.sampled_from(["", "+", "-"]), DIGITS),
    st.builds(lambda a, e, x: f"{a}e{e}{x}", DIGITS, st.sampled_from(["", "+", "-"]), st.integers(0, 30)),
    st.builds(lambda a: f" {a} ", DIGITS),
    st.sampled_from(["inf", "-inf", "nan", "-nan", "+NaN", "Infinity", "+INF", ".5", "5.", "", "n/a", "1.2.3",
                     "--1", "e5", "1e", "0x1A", "1e999", "-0"]),
    st.text(alphabet="0123456789.+-eE xa", max_size=8),
)


def _py_float(s):
    if "_" in s:
        return None
    try:
        return float(s)
    except ValueError:
        return None


def _py_int(s):
    try:
        v = int(s)
    except ValueError:
        return None
    return v if -2**31 <= v < 2**31 else None


@settings(max_examples=3, deadline=None)
@given(st.lists(NUMERIC, min_size=150, max_size=150, unique=True))
def test_text_numbers_match_python(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "c STRING").select(
        "c", parse.to_double("c").alias("d"), parse.to_int("c").alias("i"))
    for r in df.collect():
        want_d, want_i = _py_float(r.c), _py_int(r.c)
        if want_d is None:
            assert r.d is None, r.c
        elif math.isnan(want_d):
            assert r.d is not None and math.isnan(r.d), r.c
        else:
            assert r.d == want_d, r.c
        assert r.i == want_i, r.c
