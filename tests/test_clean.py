"""Truth tables of the scalar rules, as Column functions and as SQL functions."""

import pytest
from pyspark.sql import functions as F

from tallyflow.functions import clean, sqlfn, timing


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r.out for r in df.select("i", fn(F.col("s")).alias("out")).orderBy("i").collect()]


CHARSET = {
    "": True, "abc": True, "A|b-_9": True, "a b": False, "abc\n": False, "news?from=app": False, "é": False,
    "小程序": False, None: None,
}


def test_charset(spark):
    assert apply(spark, clean.has_channel_charset, CHARSET) == list(CHARSET.values())


TRIM_DATE = {
    "a240115": "a",
    "240115": "240115",          # nothing would be left
    "a240115240116": "a",
    "240115240116": "240115",
    "a991399": "a991399",        # month 13
    "a240100": "a240100",        # day 0
    "a241231": "a",
    "a240132": "a240132",
    "a000101": "a",
    "a+90131": "a",              # a signed pair parses as 9
    "a-00131": "a",
    "a-10131": "a-10131",        # and as -1 here
    "a++0131": "a++0131",
    "a24011": "a24011",
    "a240115\n": "a240115\n",
    "a" + "240115" * 6: "a240115",
    "\n240115": "\n",
    "": "",
    None: None,
}


def test_trim_date(spark):
    assert apply(spark, clean.trim_date, TRIM_DATE) == list(TRIM_DATE.values())


def step_by_step(s: str) -> str:
    """The rule as stated: one suffix at a time, at most five times."""
    for _ in range(5):
        year, month, day = s[-6:-4], s[-4:-2], s[-2:]
        unsigned = year.lstrip("+-") if year[:1] in ("+", "-") and len(year.lstrip("+-")) == 1 else year
        if len(s) < 7 or not (unsigned + month + day).isdigit():
            return s
        if int(year) < 0 or not 1 <= int(month) <= 12 or not 1 <= int(day) <= 31:
            return s
        s = s[:-6]
    return s


def test_trim_date_against_the_stepwise_rule(spark):
    import random

    rnd = random.Random(7)
    parts = ["24", "99", "+1", "-0", "-3", "00", "01", "12", "13", "31", "32", "a", "x_", "0", ""]
    values = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randint(0, 18))) for _ in range(4000)})
    assert apply(spark, clean.trim_date, values) == [step_by_step(v) for v in values]


INTEGER = {"": True, "+": True, "-": True, "12": True, "-12": True, "1-": False, "1\n": False, "a": False, None: None}


def test_is_integer(spark):
    assert apply(spark, clean.is_integer, INTEGER) == list(INTEGER.values())


def test_trim_special(spark):
    assert apply(spark, clean.trim_special, ["a\\'b'", "\\\\", "", None]) == ["ab", "", "", None]


def test_normalise_channel(spark):
    got = apply(spark, clean.normalise_channel, ["h5bt240115", "xh5bth5bt", "H5BT", None])
    assert got == ["h5", "xh5h5", "H5BT", None]


def test_clip(spark):
    assert apply(spark, lambda c: clean.clip(c, 3), ["abcd", "abc", "", None]) == ["abc", "abc", "", None]


def test_device(spark):
    values = ["x", "null", "  ", "", "\tnull\n", "\x00", " x ", None]
    assert apply(spark, clean.has_device, values) == [True, False, True, True, True, True, True, False]
    assert apply(spark, clean.has_device_trimmed, values) == [True, False, False, False, False, False, True, False]


def test_apps(spark):
    values = ["xtty", "HUITT", "huitt", "wap", "HuiTTx", None]
    # a null app is neither; a filter drops it
    assert apply(spark, clean.is_tt_app, values) == [True, False, False, False, True, None]
    assert apply(spark, clean.is_not_huitt, values) == [True, False, False, True, True, True]


def test_news_url(spark):
    urls = {
        "http://a/1": True, "https://a": True, "ftp://a": False, "http://a/video/x": False, "http://picture": False,
        "http://x.douyin": False, "xhttp://a": False, None: None,
    }
    assert apply(spark, clean.is_news_url, urls) == list(urls.values())


def rows(spark, data, ddl, **columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, " + ddl)
    return [r.out for r in df.select("i", columns["out"].alias("out")).orderBy("i").collect()]


LOG_TYPE = [("a", None, True), ("log_toutiao_sdk_active", "x http y", True), ("log_toutiao_sdk_active", "ftp", False),
            ("log_toutiao_sdk_active", None, None), (None, "http", None)]
NULL_CHANNEL = [(None, "DFTT", False), ("null", "dftt", False), (None, "wap", True), (None, "zjzyX", False),
                (None, "gsiosX", False), (None, "xZJZY", True), (None, None, None), ("a", "DFTT", True),
                ("a", None, True), ("NULL", "DFTT", True), ("", "DFTT", True)]
VISITOR = [("huitt", "u", "d", "d"), ("xHuiTTx", "u", "d", "d"), ("huitt", "u", None, "u"), ("huitt", "u", "null", "u"),
           ("a", "u", "d", "u"), ("huitt", None, None, None)]
SOFT = [("gsbrowser", "ttAndroid", "gsbrowser"), ("GSBROWSER", "ttAndroid", "tt"), (None, "ttIOS", "tt"),
        ("ltbrowser", None, "ltbrowser"), ("a", None, "null"), ("a", "ttAndroidPad", "ttAnd"), ("a", "IOS", ""),
        ("a", "AndroidIOS", "And"), ("a", "android", "android"), ("a", "plain", "plain")]


def test_rules_of_several_columns(spark):
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    two, three = "a string, b string", "a string, b string, c string"
    assert rows(spark, [r[:2] for r in LOG_TYPE], two, out=clean.keeps_log_type(a, b)) == [r[2] for r in LOG_TYPE]
    assert rows(spark, [r[:2] for r in NULL_CHANNEL], two, out=clean.keeps_null_channel(a, b)) == [r[2] for r in NULL_CHANNEL]
    assert rows(spark, [r[:3] for r in VISITOR], three, out=clean.visitor_contains(a, b, c)) == [r[3] for r in VISITOR]
    assert rows(spark, [r[:2] for r in SOFT], two, out=clean.app_from_software(a, b)) == [r[2] for r in SOFT]
    exact = [("huitt", "u", "d"), ("HuiTT", "u", "d"), ("huitt", "u", None), (None, "u", "d")]
    assert rows(spark, exact, three, out=clean.visitor_exact(a, b, c)) == ["d", "u", None, "u"]


def test_regex_group(spark):
    order = r"order/(\d+)-(\w+)"
    assert apply(spark, lambda c: clean.regex_group(c, order, 2), ["/shop/order/77-blue?x=1"]) == ["blue"]
    # the search starts at the group's number
    assert apply(spark, lambda c: clean.regex_group(c, "(a)", 1), ["ab", "ba", "aa"]) == [None, "a", "a"]
    assert apply(spark, lambda c: clean.regex_group(c, "(^a)", 1), ["aa"]) == [None]
    assert apply(spark, lambda c: clean.regex_group(c, "b+", 0), ["abb", "x", "", None]) == ["bb", None, None, None]
    assert apply(spark, lambda c: clean.regex_group(c, "", 0), ["abb", "", None]) == ["", None, None]
    assert apply(spark, lambda c: clean.regex_group(c, None, 0), ["abb"]) == [None]
    with pytest.raises(Exception, match="start position"):
        apply(spark, lambda c: clean.regex_group(c, "(a)(b)(c)", 3), ["ab"])
    with pytest.raises(Exception, match="(?i)group"):
        apply(spark, lambda c: clean.regex_group(c, "(b)", 2), ["aaab"])


def test_sql_functions(spark):
    assert len(sqlfn.register(spark)) == len(sqlfn.definitions())

    def call(name, values):
        out = []
        for v in values:
            args = v if isinstance(v, tuple) else (v,)
            names = [f"a{i}" for i in range(len(args))]
            df = spark.createDataFrame([args], ", ".join(f"{n} string" for n in names))
            out.append(df.selectExpr(f"{name}({', '.join(names)}) AS out").first().out)
        return out

    assert call("tf_trim_date", TRIM_DATE) == list(TRIM_DATE.values())
    assert call("tf_channel_ok", CHARSET) == list(CHARSET.values())
    assert call("tf_is_integer", INTEGER) == list(INTEGER.values())
    assert call("tf_trim_special", ["a\\'b'"]) == ["ab"]
    assert call("tf_normalise_channel", ["h5bt240115"]) == ["h5"]
    assert call("tf_null_text", [None, "a"]) == ["null", "a"]
    assert call("tf_log_type_ok", [r[:2] for r in LOG_TYPE]) == [r[2] for r in LOG_TYPE]
    assert call("tf_null_channel_ok", [r[:2] for r in NULL_CHANNEL]) == [r[2] for r in NULL_CHANNEL]
    assert call("tf_visitor", [r[:3] for r in VISITOR]) == [r[3] for r in VISITOR]
    assert call("tf_app_from_software", [r[:2] for r in SOFT]) == [r[2] for r in SOFT]
    assert call("tf_news_url_ok", ["http://a", "http://a/video"]) == [True, False]
    assert call("tf_format_time", ["20180409111111"]) == ["2018-04-09 11:11:11"]
    assert spark.sql("SELECT tf_floor_ten_minutes(1705326451) AS t").first().t == 1705326000


def test_report_window():
    w = timing.report_window
    assert w("20240115134731") == ("20240115", 1705276800, 1705326000)
    assert w("20240115134000") == ("20240115", 1705276800, 1705326000)
    assert w("20240116000500") == ("20240115", 1705276800, 1705363200)
    assert w("20240115001000") == ("20240115", 1705276800, 1705277400)
    assert w("20240301000000").dt == "20240229"
    shanghai = w("20240115134731", "Asia/Shanghai")
    assert shanghai == ("20240115", 1705276800 - 8 * 3600, 1705326000 - 8 * 3600)


def test_window_columns_agree_with_the_driver_side(spark):
    ticks = ["20240115134731", "20240116000500", "20240115001000", "20240101000959", "20240229235959"]
    ticks += ["20240115000331", "20240311000100", "20241104000200", "20240310120500"]
    for tz in ("UTC", "Asia/Shanghai", "Asia/Kathmandu", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            df = spark.createDataFrame([(t,) for t in ticks], "arg string")
            epoch = F.unix_timestamp(timing.parse_datetime(timing.format_time(F.col("arg"))))
            got = df.select("arg", *[c.alias(n) for n, c in timing.report_window_columns(epoch).items()]).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert {r.arg: (r.dt, r.low, r.up) for r in got} == {t: tuple(timing.report_window(t, tz)) for t in ticks}


def test_floor_example(spark):
    at = F.unix_timestamp(timing.parse_datetime(F.lit("2018-04-09 11:11:11")))
    row = spark.range(1).select(timing.tick_text(timing.floor_ten_minutes(at)).alias("t")).first()
    assert row.t == "2018-04-09 11:10:00"


def test_excluded_apps_by_id(spark):
    apps = [
        "DFTT", "TTKB", "XWZXTT", "XNTTZK", "JSSTT", "JS_DFTT", "USATT", "HBJTT", "MOPSHIPIN", "YZSTT", "DBHTT", "GSGTT", "NCJTT",
        "GZGTT", "YNYTT", "ICANTT", "JXGTT", "HNYTT", "HNQTT", "XNBLW", "XGGTT", "GDYTT", "TQYB", "TQKB", "WNWB", "GSBROWSER",
    ]
    assert len(apps) == 26
    kept = lambda c: clean.keeps_null_channel(F.lit(None).cast("string"), c)
    assert apply(spark, kept, apps) == [False] * 26
    assert apply(spark, kept, ["OTHER", "DFTT2", "XDFTT"]) == [True] * 3
