from __future__ import annotations

import itertools
import math
import random
import re

import pytest
from casework.llm import url_filter

PAGES = "page_id long, url string, html string, rule int, host int"


def page_rows():
    rng = random.Random(12)
    rows = []
    for i in range(600):
        host = ".".join([rng.choice(["www", "m", "blog", "a.b"]), rng.choice(["spamfarm", "good", "news"]), rng.choice(["example.net", "Example.com", "example.org", "other.org"])])
        path = rng.choice(["", "/", "/en/1", "/de/2", "/fr/3/pills", "/en", "/x?y=/en/", "/en/a#b"])
        rows.append((i, f"{rng.choice(['http', 'https'])}://{host}{path}"))
    rows += [(600, None), (601, ""), (602, "no scheme/at/all"), (603, "x://"), (604, "a://b.net"), (605, "a://NET/"), (606, "ftp://q?u://net/")]
    rows += [(5, rows[5][1]), (None, "http://net/x"), (607, "http://" + "a." * 5000 + "net/" + "b/" * 5000)]
    return rows


def label_of(i, url):
    return int("spamfarm" in (url or "") and "pills" in (url or "")) if i is not None and i % 2 else None


@pytest.fixture(scope="module")
def judged(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(i, u, "<p>", 1, 2) for i, u in rows], PAGES)
    labels = spark.createDataFrame([(i, 1, label_of(i, u)) for i, u in rows if label_of(i, u) is not None], "doc_id long, quality int, toxic int")
    mining = url_filter.Mining()
    return rows, url_filter.judge(pages, url_filter.page_labels(labels), mining=mining).collect(), mining


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def listed(host, path):
    fits = [
        r
        for r in url_filter.LISTED
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_hosts_paths_and_listed_rules(judged):
    rows, got, _ = judged
    assert len(got) == len(rows)
    want = sorted(((i, *parts(u), getattr(listed(*parts(u)), "text", None)) for i, u in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == want
    for r in got:
        rule = listed(r.host, r.path)
        if rule:
            assert r.verdict == rule.action and r.mined_rule is None


def tokens(url):
    host, path = parts(url)
    out = {"h:" + x for x in host.split(".") if x} | {"p:" + x for x in re.split(r"[^a-z]+", path.lower()) if x}
    if url and "://" in url:
        out |= {"s:" + url.split("://")[0].lower()} if url.split("://")[0] else set()
        query = re.match(r"[^?#]*\?([^#]*)", url.split("://", 1)[1])
        out |= {"q:" + x.split("=")[0] for x in (query.group(1) if query else "").split("&") if x.split("=")[0]}
    return out


def chance(n, k, base):
    """Chernoff's bound on a binomial tail."""
    q = k / n
    if q <= base:
        return 1.0
    rest = (1 - q) * math.log((1 - q) / (1 - base)) if q < 1 else 0.0
    return math.exp(-n * (q * math.log(q / base) + rest))


def tail(n, k, base):
    return sum(math.comb(n, i) * base**i * (1 - base) ** (n - i) for i in range(k, n + 1))


def test_the_bound_holds():
    for n in (1, 5, 20, 60):
        for k in range(n + 1):
            assert chance(n, k, 0.26) >= tail(n, k, 0.26) - 1e-12


def test_labels_without_association_give_no_rule_and_rare_bad_hosts_do(spark):
    """Production parameters: labels drawn at random, then with a host of twelve pages that are all blocked."""
    rng = random.Random(31)
    urls = [f"https://{rng.choice(['a', 'b', 'c', 'd'])}.site{rng.randrange(60)}.com/{rng.choice(['x', 'y', 'z'])}?k{rng.randrange(5)}=1" for _ in range(900)]
    pages = [(i, u) for i, u in enumerate(urls)]
    labels = [(i, 1, int(rng.random() < 0.26)) for i in range(900)]
    for bad in (0, 12):
        more = [(1000 + i, f"https://rare.bad-host.com/{i}") for i in range(bad)]
        df = spark.createDataFrame([(i, u, "", 1, 2) for i, u in pages + more], PAGES)
        known = spark.createDataFrame(labels + [(i, 1, 1) for i, _ in more], "doc_id long, quality int, toxic int")
        got = url_filter.judge(df, url_filter.page_labels(known)).collect()
        assert {r.page_id for r in got if r.verdict == "block"} == {i for i, _ in more}


def test_mined_rules_equal_exhaustive_search(judged):
    rows, got, mining = judged
    truth = {}
    for i, u in rows:
        if label_of(i, u) is not None:
            truth[i] = max(truth.get(i, 0), label_of(i, u))
    baskets = [(tokens(u), truth[i]) for i, u in rows if i in truth]
    least = max(mining.support, mining.pages / len(baskets)) * len(baskets)
    base, counts = sum(b for _, b in baskets) / len(baskets), {}
    for have, bad in baskets:
        if len(have) > 50:
            continue
        for n in range(1, len(have) + 1):
            for c in itertools.combinations(sorted(have), n):
                a, b = counts.get(c, (0, 0))
                counts[c] = (a + 1, b + bad)
    tried = sum(a >= least for a, _ in counts.values())
    rules = {
        c: b / a
        for c, (a, b) in counts.items()
        if b >= least and b / a >= mining.confidence and chance(a, b, base) * tried <= mining.chance
    }
    kept = {
        c: p
        for c, p in rules.items()
        if not any(rules.get(s, 0) >= p for s in itertools.combinations(c, len(c) - 1))
    }
    assert kept
    for r, url in zip(sorted(got, key=lambda r: repr((r.page_id, r.host, r.path))), sorted(rows, key=lambda x: repr((x[0], *parts(x[1]))))):
        hits = [p for c, p in kept.items() if set(c) <= tokens(url[1])]
        if r.rule is None:
            assert r.verdict == ("block" if hits else "allow"), url


def test_no_labels_and_no_pages(spark):
    none = url_filter.page_labels(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    pages = spark.createDataFrame([(1, "http://a.com/", "", 1, 2), (2, None, None, 1, 2)], PAGES)
    rows = url_filter.judge(pages, none).collect()
    assert {(r.page_id, r.verdict) for r in rows} == {(1, "allow"), (2, "allow")}
    assert url_filter.judge(spark.createDataFrame([], PAGES), none).count() == 0
