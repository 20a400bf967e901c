"""URL judgements against a plain loop over the rules."""

import re

import numpy as np

from vigie.llm import url_filter as U

URLS = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://x.example.org/en/2",
        "http://notexample.org/es/", "http://org/", "http://org", "ftp://a.com/de/x", "http://b.com/fr/", "http://b.com/it/",
        "http://www.SPAM-farm.example.com/en/1", "http://spam-farm.example.com/fr/2", "http://myspam-farm.example.com/", "x://a://b/de/",
        "http://b.com?q=/de/", "http://b.com/de#/fr/", "http://é.com/de/ü", "http://..com/de/", "line\nhttp://b.com/de/z", "http://b.net/" + "a" * 5000]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = lambda h: host == h or host.endswith("." + h)
    best = max(((len(h + p), h + p, v) for v, h, p in U.RULES if fits(h) and path.startswith(p)), default=None)
    if best:
        return host, path, best[1], best[2]
    return host, path, None, "block" if any(map(fits, U.BLOCKED_HOSTS)) else "allow"


def check(spark, **kw):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, **kw).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS + URLS)}


def test_files(spark):
    check(spark)


def test_list_too_large_to_ship(spark):
    check(spark, max_local_bytes=0)


def test_no_pages_and_no_list(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none).count() == 0
    empty = U.entries(spark).where("false")
    one = spark.createDataFrame([(1, "http://b.com/de/")], "page_id long, url string")
    for bound in (0, 1 << 20):
        assert [tuple(r)[4:] for r in U.judge(one, empty, max_local_bytes=bound).collect()] == [(None, "allow")]


def test_colliding_digests_are_told_apart(scratch, monkeypatch):
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda k: 5)
    a = U.DigestArray(*U.build([("a.b", "block", False, 0), ("c.d", "allow", False, 0)], scratch))
    assert a.find([b"c.d", b"a.b", b"x"]) == [[1], [0], []] and isinstance(a.digests, np.memmap)


def test_ties_are_judged_alike_on_both_paths(spark):
    """Rules of one length, and a rule that is also a blocked host, in either order."""
    rules = (("block", "a.org", "/"), ("allow", "org", "/xy"), ("allow", "com", ""), ("block", "z.net", "/q"), ("allow", "net", "/q/r"))
    urls = ["http://a.org/xy", "http://b.org/xy", "http://a.org/x", "http://com", "http://b.com/", "http://z.net/q/r", "http://net/q/r", "http://x.net"]
    want = ["block", "allow", "block", "allow", "allow", "block", "allow", "block"]
    for hosts in (("com", "x.net"), ("x.net", "com")):
        for listed in (U.entries(spark, rules, hosts), U.entries(spark, rules[::-1], hosts)):
            for bound in (0, 1 << 20):
                pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
                got = {r.page_id: (r.rule, r.verdict) for r in U.judge(pages, listed, max_local_bytes=bound).collect()}
                assert [got[i][1] for i in range(len(urls))] == want
                assert got[0][0] == "a.org/" and got[1][0] == "org/xy" and got[3][0] == "com" and got[7][0] is None
