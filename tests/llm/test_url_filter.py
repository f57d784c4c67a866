"""The temporal list join against a plain replay of the dated entries."""

import datetime as dt
import random
from urllib.parse import urlsplit

from lipika.llm import url_filter as U

DAY = dt.datetime(2024, 1, 1)


def brute(url, at, entries):
    if url is None or at is None:
        return []
    bare = url.strip().split("#")[0]
    bare = bare.split("://", 1)[1] if "://" in bare else bare
    parts = urlsplit("//" + bare)
    host = (parts.hostname or "").rstrip(".")
    path = parts.path
    rest = path + ("?" + parts.query if "?" in bare else "")
    rest = rest.rstrip("/")
    whole, path = host + rest, (host + rest).split("?")[0]
    state = {}
    for lst, kind, value, when, listed in sorted((e for e in entries if None not in e), key=lambda e: (e[3], e[4])):
        if when <= at:
            state[lst, kind, value] = listed
    hits = []
    for (lst, kind, value), on in state.items():
        match = {"domain": host == value or host.endswith("." + value), "prefix": (path + "/").startswith(value) and value.endswith("/"), "url": whole == value}[kind]
        if on and match:
            hits.append(f"{lst}:{kind}:{value}")
    return sorted(hits)


def test_against_replay(spark):
    rng = random.Random(12)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "other.org", "x.other.org"]
    paths = ["", "/", "/p", "/p/q", "/p/q/", "/p/q/r?x=1", "/pq", "?x=1"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'user@'])}{rng.choice(hosts).upper() if rng.random() < 0.3 else rng.choice(hosts)}{rng.choice(['', ':8080'])}{rng.choice(paths)}{rng.choice(['', '#f'])}" for _ in range(300)]
    captures = [(k, u, DAY + dt.timedelta(hours=rng.randint(0, 800)), "v") for k, u in enumerate(urls)]
    captures += [(None, urls[0], captures[0][2], "v"), (1, captures[1][1], captures[1][2], "v"), (900, None, DAY, "v"), (901, "", DAY, "v"), (902, urls[3], None, "v")]
    values = [*[("domain", h) for h in [*hosts, "com"]], *[("prefix", h + p) for h in hosts for p in ("/", "/p/", "/p/q/")], *[("url", h + p) for h in hosts for p in ("", "/p", "/p/q/r?x=1")]]
    entries = [(rng.choice(["l1", "l2"]), *rng.choice(values), DAY + dt.timedelta(hours=rng.randint(0, 30) * 24), rng.random() < 0.6) for _ in range(250)]
    entries += [("l1", "domain", None, DAY, True), (None, "url", "x", DAY, True)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp, uf_url string")
    e = spark.createDataFrame(entries, "list string, kind string, value string, at timestamp, listed boolean")
    found = U.evaluate(c, e)
    assert found.columns == [*c.columns, "hits"]
    rows = found.collect()
    assert len(rows) == len(captures) and sum(bool(r.hits) for r in rows) > 50
    for r in rows:
        assert r.hits == brute(r.url, r.fetched_at, entries), r.url


def test_interval_edges_and_empty(spark):
    c = spark.createDataFrame([(k, "http://h.org/x", DAY + dt.timedelta(days=k)) for k in range(4)], "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame([("l", "domain", "h.org", DAY + dt.timedelta(days=1), True), ("l", "domain", "h.org", DAY + dt.timedelta(days=3), False)], "list string, kind string, value string, at timestamp, listed boolean")
    assert {r.page_id: bool(r.hits) for r in U.evaluate(c, e).collect()} == {0: False, 1: True, 2: True, 3: False}
    assert all(r.hits == [] for r in U.evaluate(c, e.limit(0)).collect())
    assert U.evaluate(c.limit(0), e).count() == 0
