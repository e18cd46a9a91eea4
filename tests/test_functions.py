import unicodedata
from datetime import datetime

from emporium.functions import (apply_contains_rules, delay_bucket, normalize_place, on_time_flag,
                                parse_timestamp, safe_divide, strip_accents, strip_whitespace)


def _ref_strip(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_strip_accents_matches_nfkd(spark):
    samples = ["São Paulo", "Brasília", "½ litro", "ﬁm", "한국어", "Ĳssel ŉ", "ª º", "x́y",
               "㍿", "\U0001D400bc", "Ünïcödé Straße", "plain ascii", ""]
    rows = spark.createDataFrame([(s,) for s in samples] + [(None,)], "s string") \
        .select("s", strip_accents("s").alias("o")).collect()
    for r in rows:
        if r.s is None:
            assert r.o is None
        else:
            assert r.o == _ref_strip(r.s), r.s


def test_strip_whitespace_is_unicode_aware(spark):
    s = " \t\n São Paulo  \r\n"
    out = spark.createDataFrame([(s,)], "s string").select(strip_whitespace("s").alias("o")).first().o
    assert out == s.strip()


def test_city_normalisation_and_rules(spark):
    cities = [" São Paulo - SP ", "\tRio de Janeiro / RJ\n", "SAO MIGUEL", "sao paulo / rio de janeiro",
              "Brasília", None]
    df = spark.createDataFrame([(c,) for c in cities], "c string")
    out = [r.o for r in df.select(apply_contains_rules(normalize_place("c")).alias("o")).collect()]
    assert out == ["sao paulo", "rio de janeiro", "sao miguel d'oeste", "rio de janeiro", "brasilia", None]
    legacy = df.select(normalize_place("c", legacy_nan=True).alias("o")).collect()[-1].o
    assert legacy == "nan"


def test_parse_timestamp_bad_text_is_null(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("not a date",), (None,)], "s string")
    out = [r.t for r in df.select(parse_timestamp("s").alias("t")).collect()]
    assert out == [datetime(2017, 10, 2, 10, 56, 33), None, None]


def test_delay_buckets_and_on_time(spark):
    days = [-10, -7, -6, -1, 0, 1, 7, 8, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    out = [r.b for r in df.select(delay_bucket("d").alias("b")).collect()]
    assert out == ["Very Early", "Very Early", "Early", "Early", "On Time", "Late", "Late", "Very Late",
                   "Not Delivered"]
    ts = spark.createDataFrame([(datetime(2020, 1, 2), datetime(2020, 1, 3)),
                                (datetime(2020, 1, 4), datetime(2020, 1, 3)),
                                (None, datetime(2020, 1, 3))], "d timestamp_ntz, e timestamp_ntz")
    assert [r.f for r in ts.select(on_time_flag("d", "e").alias("f")).collect()] == [1, 0, 0]


def test_safe_divide_blank_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 2)], "a int, b int")
    assert [r.q for r in df.select(safe_divide("a", "b").alias("q")).collect()] == [None, None, 1.5]
