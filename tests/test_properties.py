"""Property test: accent stripping equals NFKD-minus-combining-marks on random Unicode text."""
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from emporium.functions import strip_accents

ALPHABET = st.one_of(
    st.characters(min_codepoint=0x20, max_codepoint=0x24F),           # Latin with accents
    st.characters(min_codepoint=0x300, max_codepoint=0x36F),          # combining marks
    st.characters(min_codepoint=0xAC00, max_codepoint=0xD7A3),        # Hangul syllables
    st.characters(min_codepoint=0x2150, max_codepoint=0x218F),        # number forms
    st.characters(min_codepoint=0xFB00, max_codepoint=0xFB4F),        # ligatures
    st.characters(min_codepoint=0x3300, max_codepoint=0x33FF),        # squared CJK
    st.characters(min_codepoint=0x1D400, max_codepoint=0x1D7FF),      # math alphanumerics
)


def _ref(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=50, max_size=80))
def test_strip_accents_property(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string") \
        .select("s", strip_accents("s").alias("o")).collect()
    for r in rows:
        assert r.o == _ref(r.s), repr(r.s)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.just(float("nan"))), min_size=1, max_size=300),
       st.integers(1, 9))
def test_exact_quantiles_property(spark, values, parts):
    import math

    import pandas as pd

    from emporium.operators.quantiles import exact_quantiles
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    series = pd.Series(values, dtype="float64")
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], probs, partitions=parts).collect()}
    for p in probs:
        expect = series.quantile(p)
        if math.isnan(expect):
            assert got[p] is None
        else:
            assert abs(got[p] - expect) < 1e-9, (p, got[p], expect)
