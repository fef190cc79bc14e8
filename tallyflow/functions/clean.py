"""Cleaning rules for channel, visitor, device and app ids, as Column expressions.

Everything here is a built-in expression, so a scan that uses it stays inside whole-stage
codegen and Catalyst can still push the pushable parts to the file source.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: they decide the results ---------------------------------------------
NULL_TEXT = "null"
SDK_ACTIVE_LOGTYPE = "log_toutiao_sdk_active"
HUITT = "huitt"
MINI_PROGRAM_CHANNELS = ["sharexcx", "xiaochengxu_dftt"]
SDK_TOTAL = "sdk_total"
MINI_PROGRAM_TOTAL = "小程序汇总"
TOTAL = "total"
BROWSERS = ["gsbrowser", "ltbrowser"]
EXCLUDED_APPS = [
    "DFTT", "TTKB", "XWZXTT", "XNTTZK", "JSSTT", "JS_DFTT", "USATT", "HBJTT", "MOPSHIPIN", "YZSTT", "DBHTT", "GSGTT",
    "NCJTT", "GZGTT", "YNYTT", "ICANTT", "JXGTT", "HNYTT", "HNQTT", "XNBLW", "XGGTT", "GDYTT", "TQYB", "TQKB", "WNWB",
    "GSBROWSER",
]
EXCLUDED_APP_PREFIX = r"^ZJZY|^GSIOS"
# \z and not $: rlike looks for a match anywhere, and $ would accept a trailing newline
CHANNEL_CHARSET = r"^[a-zA-Z0-9|_-]*\z"
SIGNED_INTEGER = r"^[-+]?[0-9]*\z"
# one to five yyMMdd groups at the end, something in front; the first pair may carry a sign
# that integer parsing accepts and that keeps the value >= 0
DATE_SUFFIX = (
    r"(?s)^(.+?)(?:(?:[0-9]{2}|\+[0-9]|-0)(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])){1,5}\z"
)
QID_WIDTH = 50
APP_WIDTH = 20
APP_TOTAL_WIDTH = 50
# -----------------------------------------------------------------------------------------

# a trim that strips every character up to and including the blank
_BLANKS = "".join(chr(i) for i in range(33))


def null_text(c: Column) -> Column:
    """Null becomes the literal text ``null``."""
    return F.coalesce(c, F.lit(NULL_TEXT))


# ---- predicates -------------------------------------------------------------------------

def between(dateline: Column, low: int, up: int) -> Column:
    """Cumulative range, closed at both ends."""
    return dateline.between(F.lit(low).cast("bigint"), F.lit(up).cast("bigint"))


def last_ten_minutes(dateline: Column, up: int) -> Column:
    """``(up - 600, up]``."""
    return (dateline > F.lit(up - 600).cast("bigint")) & (dateline <= F.lit(up).cast("bigint"))


def keeps_log_type(logtype: Column, urlto: Column) -> Column:
    """SDK activity rows count only with an http target; a null type is dropped."""
    return (logtype != SDK_ACTIVE_LOGTYPE) | ((logtype == SDK_ACTIVE_LOGTYPE) & urlto.rlike("http"))


def keeps_null_channel(qid: Column, apptypeid: Column) -> Column:
    """Rows without a channel count only for apps off the exclusion list; a null app is dropped."""
    app = F.upper(apptypeid)
    allowed = ~app.isin(EXCLUDED_APPS) & ~app.rlike(EXCLUDED_APP_PREFIX)
    return (null_text(qid) != NULL_TEXT) | allowed


def has_channel_charset(qid: Column) -> Column:
    """Only letters, digits, ``|``, ``-`` and ``_``; empty passes."""
    return qid.rlike(CHANNEL_CHARSET)


def has_device(device: Column) -> Column:
    return device.isNotNull() & (device != NULL_TEXT)


def has_device_trimmed(device: Column) -> Column:
    return device.isNotNull() & ~F.btrim(device, F.lit(_BLANKS)).isin(NULL_TEXT, "")


def is_tt_app(apptypeid: Column) -> Column:
    return F.upper(apptypeid).contains("TT") & (F.lower(apptypeid) != HUITT)


def is_not_huitt(apptypeid: Column) -> Column:
    return F.lower(null_text(apptypeid)) != HUITT


def is_news_url(urlto: Column) -> Column:
    return (
        urlto.like("http%")
        & ~urlto.like("http%video%")
        & ~urlto.like("http%picture%")
        & ~urlto.like("http%douyin%")
    )


def is_mini_program(qid: Column) -> Column:
    return qid.isin(MINI_PROGRAM_CHANNELS)


# ---- projections ------------------------------------------------------------------------

def visitor_exact(qid: Column, uid: Column, device: Column) -> Column:
    """The device stands in for the visitor on exactly the ``huitt`` channel."""
    return F.when(qid == HUITT, device).otherwise(uid)


def visitor_contains(qid: Column, uid: Column, device: Column) -> Column:
    """The device stands in for the visitor on any channel containing ``huitt``, if there is one."""
    return F.when(F.lower(qid).contains(HUITT) & has_device(device), device).otherwise(uid)


def trim_special(c: Column) -> Column:
    """Drop backslashes and single quotes."""
    return F.translate(c, "\\'", "")


def trim_date(c: Column) -> Column:
    """Drop up to five trailing ``yyMMdd`` suffixes, keeping at least one leading character.

    A suffix ends in a month and a day; text that cannot end so, most of it, skips the pattern.
    """
    may_end_in_date = F.substring(c, -4, 4).between("0101", "1231")
    return F.when(may_end_in_date, F.regexp_replace(c, DATE_SUFFIX, "$1")).otherwise(c)


def normalise_channel(c: Column) -> Column:
    """``h5bt`` becomes ``h5``, then the date suffixes go."""
    return trim_date(F.replace(c, F.lit("h5bt"), F.lit("h5")))


def app_from_software(softname: Column, softid: Column) -> Column:
    """App id of an activity row: the browser name, or the software id less its platform's length.

    The platform marker is looked for anywhere, but characters are always cut off the end.
    """
    name, sid = null_text(softname), null_text(softid)
    cut = F.when(sid.contains("Android"), 7).when(sid.contains("IOS"), 3).otherwise(0)
    return F.when(name.isin(BROWSERS), name).otherwise(F.substring(sid, F.lit(1), F.length(sid) - cut))


def clip(c: Column, width: int) -> Column:
    return F.substring(c, 1, width)


def is_integer(c: Column) -> Column:
    """Digits with an optional sign; empty and a lone sign pass."""
    return c.rlike(SIGNED_INTEGER)


def regex_group(c: Column, pattern: str | None, index: int) -> Column:
    """Group ``index`` of the first match starting at character ``index`` or later.

    Null or empty text gives null, as does no match, and a group that exists but takes no part in the match. A
    null or empty pattern is returned as it is. Text shorter than the start position, or a group the pattern
    lacks, is an error.
    """
    if not pattern:
        text_only = F.lit(pattern).cast("string")
        return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(text_only)
    full = pattern if index == 0 else rf"^(?s:.{{{index},}}?)(?:{pattern})"
    # a look-ahead keeps its groups, and a reference to one that took no part fails
    took_part = F.lit(True) if index == 0 else c.rlike(rf"^(?=(?s:.{{{index},}}?)(?:{pattern}))(?s:.*?)\{index}")
    too_short = F.raise_error(F.lit(f"text is shorter than start position {index}")).cast("string")
    group = F.regexp_extract(c, full, index)
    return (
        F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
        .when(F.length(c) < index, too_short)
        .when(c.rlike(full), F.when(group.isNull() | took_part, group))
    )
