import datetime as dt
import random

import pytest

from plumbline.llm import url_filters as U

CHANGES = "list string, key string, at timestamp, action string, verdict string"
CAPTURES = "capture bigint, url string, fetched timestamp"


def day(n, hour=0):
    return dt.datetime(2023, 1, 1) + dt.timedelta(days=n, hours=hour)


def keys(url):
    import re
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::\d+)?(/[^?#]*)?", url or "")
    if not m:
        return set()
    host = re.sub(r"\.$", "", m[1].lower())
    labels = host.split(".")
    steps = [s for s in (m[2] or "").split("/") if s]
    return {".".join(labels[i:]) for i in range(len(labels))} | {"/".join([host, *steps[:i + 1]]) for i in range(len(steps))}


def brute(captures, changes):
    logs = {}
    for name, key, at, action, verdict in changes:
        if key is not None and at is not None:
            logs.setdefault((name, key), {}).setdefault(at, []).append((action == "remove", verdict))
    out = []
    for capture, url, fetched in captures:
        active = []
        for (name, key), log in logs.items():
            before = [a for a in log if fetched is not None and a <= fetched]
            if before and key in keys(url):
                removed, verdict = max(log[max(before)])
                if not removed:
                    active.append((len(key), key, verdict))
        best = max(active, default=(0, None, None))
        out.append((capture, len(active), best[1], best[2], best[2] == "block"))
    return sorted(out, key=repr)


def cases(seed):
    pick = random.Random(seed)
    hosts = ["a.com", "x.a.com", "B.org", "c.d.e.org", "hot.net"]
    urls = ["http://" + pick.choice(hosts) + pick.choice(["", "/", "/p", "/p/q?x=/z", "/p/q/r#f", ":80/p"]) for _ in range(40)]
    urls += ["http://hot.net/p"] * 60 + [None, "", "no url", "https://u:p@x.a.com./p", "http:///x", "ftp://b.org"]
    captures = [(i, u, None if i % 31 == 5 else day(pick.randrange(-40, 500), pick.randrange(24))) for i, u in enumerate(urls)]
    entries = ["a.com", "com", "x.a.com", "b.org", "hot.net", "hot.net/p", "x.a.com/p/q", "e.org", "never.example"]
    changes = [(pick.choice(["one", "two"]), pick.choice(entries), day(pick.randrange(-30, 400)), pick.choice(["add", "add", "remove"]), pick.choice(["block", "allow", "watch"]))
               for _ in range(80)]
    changes += [("one", None, day(1), "add", "block"), ("one", "a.com", None, "add", "block"), changes[0], changes[0]]
    changes += [("one", "hot.net", day(100), a, v) for a, v in (("add", "block"), ("add", "watch"))] + [("two", "hot.net", day(100), a, "block") for a in ("add", "remove")]
    captures += [(1000, "http://hot.net", day(100)), (1001, "http://hot.net", day(100) - dt.timedelta(seconds=1))]
    return captures, changes


@pytest.mark.parametrize("seed,slot_seconds,hot_rows", [(1, U.SLOT_SECONDS, U.HOT_ROWS), (2, 86400, 3), (3, 400 * 86400, 2)])
def test_against_brute_force(spark, seed, slot_seconds, hot_rows):
    captures, changes = cases(seed)
    got = U.decisions(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(changes, CHANGES), slot_seconds, hot_rows).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(captures, changes)


def test_empty(spark):
    captures, changes = cases(1)
    c, e = spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(changes, CHANGES)
    assert U.decisions(c, e.limit(0)).where("NOT blocked AND n_active = 0").count() == len(captures)
    assert U.decisions(c.limit(0), e).count() == 0


def test_clashing_columns(spark):
    captures, changes = cases(2)
    c = spark.createDataFrame([(*x, "k", "s", 1) for x in captures], CAPTURES + ", key string, slot string, salt int")
    e = spark.createDataFrame([(*x, "u", 1) for x in changes], CHANGES + ", until string, slot int")
    assert sorted([tuple(r) for r in U.decisions(c, e).collect()], key=repr) == brute(captures, changes)


def test_repeated_and_null_captures(spark):
    changes = [("one", "a.com", day(0), "add", "block"), ("two", "com", day(0), "add", "watch")]
    captures = [(1, "http://a.com", day(5)), (1, "http://a.com", day(5)), (1, "http://b.com", day(5)), (None, "http://a.com", day(5)),
                (None, "http://c.org", day(5)), (2, "http://a.com", day(-5))]
    got = U.decisions(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(changes, CHANGES)).collect()
    want = [(1, 2, "a.com", "block", True), (1, 2, "a.com", "block", True), (1, 1, "com", "watch", False), (None, 2, "a.com", "block", True),
            (None, 0, None, None, False), (2, 0, None, None, False)]
    assert sorted([tuple(r) for r in got], key=repr) == sorted(want, key=repr) == brute(captures, changes)
