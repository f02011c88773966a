import datetime as dt
import random

from pyspark.sql import functions as F

from tidewire.llm import url_filters

DAY = dt.datetime(2024, 1, 1)
CAPTURES = "cap int, url string, at timestamp_ntz, rule string, salt int"
ENTRIES = "rule string, category string, action string, dated timestamp_ntz, url string"


def day(n, hours=0):
    return DAY + dt.timedelta(days=n, hours=hours)


def verdicts(spark, captures, entries):
    left = spark.createDataFrame([(i, u, t, "r", 1) for i, (u, t) in enumerate(captures)], CAPTURES)
    right = spark.createDataFrame([(*e, "x") for e in entries], ENTRIES)
    rows = url_filters.evaluate(left, right, "url", "at").collect()
    assert len(rows) == len(captures)
    return {row["row"]["cap"]: (row["n_active"], row["categories"], row["blocked"]) for row in rows}


def test_keys(spark):
    urls = [
        "https://user:p@www.A.Example.org:80/x//y/z/w?q=1#f", "http://example.org", "ftp://h/", "no url", "",
        None, "http://b.example.org./?q", "https://x.y/a",
    ]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [row[0] for row in frame.select(url_filters.keys_of(F.col("u"))).collect()]
    host = "a.example.org"
    assert got == [
        [host, "example.org", f"{host}/x", f"{host}/x/y", f"{host}/x/y/z"], ["example.org"], ["h"], [], [], [],
        ["b.example.org", "example.org"], ["x.y", "x.y/a"],
    ]


def test_verdicts_at_the_time_of_fetch(spark):
    entries = [
        ("bad.org", "spam", "add", day(1)), ("bad.org", "spam", "add", day(2)), ("bad.org", "spam", "remove", day(5)),
        ("bad.org", "spam", "add", day(8)), ("bad.org/ok", "allow", "add", day(0)), ("h.bad.org", "malware", "remove", day(1)),
        ("tie.org", "spam", "add", day(1)), ("tie.org", "spam", "remove", day(1)),
        (None, "spam", "add", day(0)), ("bad.org", "spam", None, day(0)), ("bad.org", "spam", "add", None),
        ("bad.org", "spam", "add", day(8)),
    ]
    captures = [
        ("http://bad.org/", day(0, 23)), ("http://bad.org/", day(1)), ("http://h.bad.org/", day(4, 23)),
        ("http://bad.org/", day(5)), ("http://bad.org/", day(9)), ("http://bad.org/ok/x", day(9)),
        ("http://h.bad.org/ok", day(9)), ("http://tie.org", day(3)), (None, day(9)), ("http://bad.org/", None),
        ("http://bad.org/", day(9)), ("junk", day(9)),
    ]
    no, spam = (0, "", False), (1, "spam", True)
    assert verdicts(spark, captures, entries) == dict(
        enumerate([no, spam, spam, no, spam, (2, "allow,spam", False), spam, no, no, no, spam, no])
    )
    assert verdicts(spark, captures[:2], []) == {0: no, 1: no}
    assert verdicts(spark, [], entries) == {}


def test_against_brute_force(spark):
    rng = random.Random(2)
    hosts = [f"{a}.{b}.org" for a in "abc" for b in "xyz"]
    rules = [*hosts, "x.org", "y.org", *[f"{h}/p" for h in hosts]]
    entries = list(
        {
            (rng.choice(rules), rng.choice(["spam", "ads", "allow"]), rng.choice(["add", "remove"]), day(rng.randint(0, 20)))
            for _ in range(400)
        }
    )
    captures = [(f"http://{rng.choice(hosts)}/{rng.choice('pq')}/1", day(rng.randint(0, 21), rng.choice([0, 5]))) for _ in range(200)]
    captures += [("http://a.x.org/p/1", day(10))] * 200  # a hot host, copies
    want = {}
    for i, (url, at) in enumerate(captures):
        host, part = url[7:].split("/")[:2]
        keys = {host, host.split(".", 1)[1], f"{host}/{part}", f"{host}/{part}/1"}
        active = []
        for rule, category in {(e[0], e[1]) for e in entries if e[0] in keys}:
            log = [(e[3], e[2]) for e in entries if e[:2] == (rule, category) and e[3] <= at]
            if log and max(log)[1] == "add":
                active.append((rule, category))
        allow = max([len(r) for r, c in active if c == "allow"], default=-1)
        block = max([len(r) for r, c in active if c != "allow"], default=-1)
        want[i] = (len(active), ",".join(sorted({c for _, c in active})), block > allow)
    assert verdicts(spark, captures, entries) == want


def test_rules_of_deep_paths(spark):
    entries = [
        ("h.org/a/b/c/d", "spam", "add", day(0)), ("h.org/a", "allow", "add", day(0)),
        ("h.org/a/b/c/d/e/f", "allow", "add", day(0)),
    ]
    captures = [(f"http://h.org/{path}", day(1)) for path in ("a/b/c", "a/b/c/d", "a/b/c/d/e", "a/b/c/d/e/f/g")]
    assert verdicts(spark, captures, entries) == {
        0: (1, "allow", False), 1: (2, "allow,spam", True), 2: (2, "allow,spam", True), 3: (3, "allow,spam", False),
    }
