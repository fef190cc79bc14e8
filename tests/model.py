"""Reports computed row by row in Python, to check the Spark plans on small random logs."""

import random
import re
from collections import defaultdict

from tallyflow.functions import clean
from tallyflow.functions.timing import ReportWindow
from tests.test_clean import step_by_step

DAY = 1705276800  # 2024-01-15 00:00:00 UTC
DT = "20240115"


def _charset(s):
    return re.fullmatch(r"[a-zA-Z0-9|_-]*", s) is not None


def _device(d):
    return d is not None and d != "null"


def count(groups, rows, up):
    """Metrics per label; ``groups(row)`` gives (label, hits) pairs, rows are (dateline, visitor, ip, ...)."""
    acc = defaultdict(lambda: {k: set() for k in ("uv", "ip", "incr_uv", "incr_ip")} | {"pv": 0, "incr_pv": 0})
    for r in rows:
        recent = up - 600 < r["dateline"] <= up
        for label, hits in groups(r):
            a = acc[label]
            a["pv"] += hits
            a["uv"].add(r["uid"])
            a["ip"].add(r["clientip"])
            if recent:
                a["incr_pv"] += hits
                a["incr_uv"].add(r["uid"])
                a["incr_ip"].add(r["clientip"])
    return {k: {m: v if isinstance(v, int) else len(v) for m, v in a.items()} for k, a in acc.items()}


ZERO = dict.fromkeys(["pv", "uv", "ip", "incr_pv", "incr_uv", "incr_ip"], 0)
METRICS = list(ZERO)


def inside(r, w: ReportWindow):
    return r["dt"] == w.dt and w.low <= r["dateline"] <= w.up


def h5_rows(log, w):
    out = []
    for r in log:
        if not inside(r, w) or r["logtype"] is None:
            continue
        if r["logtype"] == clean.SDK_ACTIVE_LOGTYPE and "http" not in (r["urlto"] or ""):
            continue
        qid = "null" if r["qid"] is None else r["qid"]
        if qid == "null":
            app = r["apptypeid"]
            if app is None or app.upper() in clean.EXCLUDED_APPS or app.upper().startswith(("ZJZY", "GSIOS")):
                continue
        if not _charset(qid):
            continue
        uid = r["clientime"] if "huitt" in qid.lower() and _device(r["clientime"]) else r["uid"]
        out.append({"dateline": r["dateline"], "clientip": r["clientip"], "qid": qid, "uid": uid})
    return out


def active_rows(log, w):
    rows = [r | {"qid": "null" if r["qid"] is None else r["qid"], "clientip": None} for r in log if inside(r, w)]
    return [r for r in rows if _charset(r["qid"])]


def h5_full(log, active_log, sdk, w):
    """Report rows as sorted tuples (qid, pv .. incr_ip, activecnt, incr_activecnt)."""
    on_list = {s for s in sdk if s is not None}

    def detail(r):
        out = [(r["qid"].lower(), 1)]
        if r["qid"] in on_list:
            out.append((clean.SDK_TOTAL, 1))
        if r["qid"] in clean.MINI_PROGRAM_CHANNELS:
            out.append((clean.MINI_PROGRAM_TOTAL, 1))
        return out

    total = lambda r: [("total", 0 if r["qid"].lower() == clean.SDK_TOTAL else 1)]
    rows, act = h5_rows(log, w), active_rows(active_log, w)
    out = []
    for groups, always in ((detail, False), (total, True)):
        t, a = count(groups, rows, w.up), count(groups, act, w.up)
        for label in {"total"} if always else t:
            m, n = t.get(label, ZERO), a.get(label, ZERO)
            out.append((label[:50], *[m[k] for k in METRICS], n["uv"], n["incr_uv"]))
    return sorted(out)


def app_rows(log, w):
    out = []
    for r in log:
        app, qid = r["apptypeid"], "null" if r["appqid"] is None else r["appqid"]
        if inside(r, w) and _device(r["clientime"]) and app and "TT" in app.upper() and app.lower() != "huitt" and _charset(qid):
            out.append(r | {"qid": qid, "uid": r["clientime"]})
    return out


def news_rows(log, w):
    out = []
    for r in log:
        url, device, app = r["urlto"], r["clientime"], "null" if r["apptypeid"] is None else r["apptypeid"]
        if not inside(r, w) or url is None or not url.startswith("http"):
            continue
        if any(x in url[4:] for x in ("video", "picture", "douyin")) or device is None:
            continue
        if device.strip("".join(map(chr, range(33)))) in ("", "null") or app.lower() == "huitt":
            continue
        qid = "null" if r["appqid"] is None else step_by_step(r["appqid"].replace("h5bt", "h5"))
        if _charset(qid):
            out.append(r | {"qid": qid, "uid": device, "apptypeid": app})
    return out


def app_report(rows, w, total_width=50):
    label = lambda r: ("null" if r["apptypeid"] is None else r["apptypeid"]).upper()
    detail = count(lambda r: [((label(r), step_by_step(r["qid"]).lower()), 1)], rows, w.up)
    total = count(lambda r: [((label(r), "total"), 1)], rows, w.up)
    return sorted(
        [(a[:20], q[:50], *[m[k] for k in METRICS]) for (a, q), m in detail.items()]
        + [(a[:total_width], q, *[m[k] for k in METRICS]) for (a, q), m in total.items()]
    )


# ---- random logs ----------------------------------------------------------------------------

QIDS = [None, "null", "sharexcx", "xiaochengxu_dftt", "SHAREXCX", "huitt", "xHuiTT", "click_1", "CLICK_1", "view_2", "a?b",
        "sdk_total", "SDK_TOTAL", "total", "", "x" * 50 + "a", "x" * 50 + "b", "ch240115", "ch", "h5btq240115240116",
        "240115", "ch240115\n", "q" + "240115" * 7]
APPS = [None, "DFTT", "zjzy_a", "huitt", "jstt2", "JSTT2", "wap", "MyVeryLongApplicationTTName", "MyVeryLongApplicationTTNaming"]
SDK = ["click_1", "view_2", "view_2", None, "nowhere"]


def random_logs(seed: int, n: int = 400):
    rnd = random.Random(seed)
    edge = [DAY, DAY + 1, DAY + 600, DAY + 601, DAY + 86399, DAY + 86400, DAY + 49200, DAY + 48600, DAY + 48601, DAY - 1]

    def row():
        dateline = rnd.choice(edge) if rnd.random() < 0.3 else DAY + rnd.randrange(86400)
        return {
            "dateline": dateline,
            "dt": DT if rnd.random() < 0.9 else rnd.choice(["20240114", "20240116"]),
            "clientip": rnd.choice([None, "null", "1", "2", "3", "4"]),
            # one channel has a third of all rows
            "qid": "click_1" if rnd.random() < 0.33 else rnd.choice(QIDS),
            "uid": rnd.choice([None, "null", "", *[f"u{i}" for i in range(9)]]),
            "clientime": rnd.choice([None, "null", " ", "\tnull", "d1", "d2", "d3"]),
            "apptypeid": rnd.choice(APPS),
            "logtype": rnd.choice(["log_a", "log_b", "log_toutiao_sdk_active", None]),
            "urlto": rnd.choice([None, "http://a", "https://video", "ftp://http", "http://x/picture", "http://douyin"]),
        }

    rows = [row() for _ in range(n)]
    active = [{"dateline": r["dateline"], "uid": r["uid"], "qid": rnd.choice([r["qid"], "active_only"]), "dt": r["dt"]}
              for r in rows if rnd.random() < 0.5]
    return rows, active
