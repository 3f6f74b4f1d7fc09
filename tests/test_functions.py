import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapsewise import functions as LF
from lapsewise.functions.numeric import ratio_half_up

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_py_strip_matches_python(spark):
    samples = ["  a b  ", "\x1c x \x1f", "　 y ", "", "   ", "\tz\t\n", "a​b", " ​ "]
    samples += [WS + "mid" + WS, "x" + WS]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.t for r in df.select(LF.py_strip("s").alias("t")).collect()]
    assert got == [s.strip() for s in samples]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab|,;\t .") + ["\\", "$"]), max_size=12), min_size=1, max_size=8),
       st.sampled_from(["|", ",", "\t", ";", ".", "\\", "$", "ab"]))
def test_split_literal_and_count_match_python(spark, texts, delim):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(
        LF.split_literal("s", delim).alias("a"), LF.field_count("s", delim).alias("n")
    ).collect()
    for t, r in zip(texts, rows):
        assert r.a == t.split(delim)
        assert r.n == len(t.split(delim))


def test_calendar_expressions(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2023, 2, 28), dt.date(2024, 4, 6)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        LF.date_key("d").alias("k"), LF.day_of_week_sunday0("d").alias("dow"),
        LF.month_name("d").alias("m"), LF.day_name("d").alias("dn"),
        LF.is_month_start("d").alias("s"), LF.is_month_end("d").alias("e"),
    ).collect()
    for d, r in zip(days, rows):
        assert r.k == int(d.strftime("%Y%m%d"))
        assert r.dow == (d.isoweekday() % 7)
        assert r.m == d.strftime("%B") and r.dn == d.strftime("%A")
        assert r.s == (d.day == 1)
        assert r.e == ((d + dt.timedelta(days=1)).day == 1)


def test_parse_date_accepts_text_and_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-05",), ("2024-01-05 13:45:00",), ("2024-01-05T23:59:59",), ("garbage",), (None,)], "v string"
    )
    got = [r.d for r in df.select(LF.parse_date("v").alias("d")).collect()]
    assert got == [dt.date(2024, 1, 5)] * 3 + [None, None]
    ts = spark.createDataFrame([(dt.datetime(2024, 3, 1, 22, 0),)], "t timestamp")
    assert ts.select(LF.parse_date("t").alias("d")).first().d == dt.date(2024, 3, 1)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=6),
       st.integers(min_value=1, max_value=10**6))
def test_ratio_half_up_is_exact(spark, cents, den):
    rows = [(Decimal(c).scaleb(-2), den) for c in cents]
    df = spark.createDataFrame(rows, "num decimal(20,2), den long")
    got = [r.q for r in df.select(ratio_half_up(F.col("num"), F.col("den")).alias("q")).collect()]
    want = [(n / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for n, d in rows]
    assert got == want


def test_ratio_half_up_avoids_double_rounding(spark):
    # true mean 1.0049999975 must round to 1.00, not 1.01
    n = 400_000_000
    df = spark.createDataFrame([(Decimal("401999999.00"), n)], "s decimal(20,2), n long")
    assert df.select(ratio_half_up(F.col("s"), F.col("n")).alias("q")).first().q == Decimal("1.00")
    assert df.select(ratio_half_up(F.col("s") * 0, F.col("n") * 0).alias("q")).first().q is None


def test_md5_and_salted_hash(spark):
    import hashlib

    df = spark.createDataFrame([("John Doe",)], "name string")
    r = df.select(LF.md5_hash("name").alias("a"), LF.salted_sha256("name", "pepper").alias("b")).first()
    assert r.a == hashlib.md5(b"John Doe").hexdigest()
    assert r.b == hashlib.sha256(b"pepperJohn Doe").hexdigest()
