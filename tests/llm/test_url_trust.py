from __future__ import annotations

import re

from gridcast.llm import url_trust
from gridcast.llm.queries import QUERIES, RULES
from tests.llm.conftest import SF, rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(LOW), m[2]) if m else ("", "")


def rule_of(host, path, rules):
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_query_follows_the_rules(spark):
    got = {r.page_id: r for r in QUERIES["op2_link_trust"](spark, SF).collect()}
    pages = rows("pages")
    assert len(got) == len(pages)
    for p in pages:
        host, path = parts(p["url"])
        rule, verdict = rule_of(host, path, RULES)
        r = got[p["page_id"]]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def page(i, host, *links):
    return (i, f"http://{host}/p{i}", "".join(f'<a href="{x}">x</a>' for x in links))


def brute(edges, seeds, damping=0.85, tolerance=0.01):
    way, out, start = dict(seeds), dict(seeds), sum(seeds.values())
    while edges and sum(way.values()) > tolerance * start:
        new = {}
        for (a, b), n in edges.items():
            total = sum(m for (x, _), m in edges.items() if x == a)
            if a in way:
                new[b] = new.get(b, 0) + damping * way[a] * n / total
        way = new
        for h, m in new.items():
            out[h] = out.get(h, 0) + m
    return {h: (1 - damping) * m for h, m in out.items()}


def test_trust_and_distrust_spread_along_links(spark):
    pages = [
        page(1, "good.a", "http://mid.c/", "//FAR.d/x", "/own", "mailto:x@bad.b"),
        page(2, "bad.b", "http://good.a/"),
        page(3, "spam.e", "http://bad.b/1", "http://bad.b/2", "http://mid.c"),
        page(4, "mid.c", "http://far.d/"),
        page(5, "far.d"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = [("allow", "good.a", "/"), ("block", "bad.b", "/")]
    got = {r.host: r for r in url_trust.url_verdicts(df, rules).collect()}
    links = {("good.a", "mid.c"): 1, ("good.a", "far.d"): 1, ("bad.b", "good.a"): 1, ("spam.e", "bad.b"): 2, ("spam.e", "mid.c"): 1, ("mid.c", "far.d"): 1}
    trust = brute(links, {"good.a": 1.0})
    distrust = brute({(b, a): n for (a, b), n in links.items()}, {"bad.b": 1.0})
    for h, r in got.items():
        assert abs(r.trust - trust.get(h, 0)) < 1e-9 and abs(r.distrust - distrust.get(h, 0)) < 1e-9
    assert {h: r.verdict for h, r in got.items()} == {
        "good.a": "allow", "bad.b": "block", "spam.e": "block", "mid.c": "allow", "far.d": "allow",
    }


def test_trusted_hosts_do_not_end_the_distrust_walk(spark):
    # bad.b is two links away; thousands of trusted hosts have no links.
    pages = [page(1, "bad.b"), page(2, "near.c", "http://bad.b/"), page(3, "far.d", "http://near.c/")]
    pages += [page(10 + i, f"h{i}.good") for i in range(1000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.host: r for r in url_trust.url_verdicts(df, [("allow", "good", "/"), ("block", "bad.b", "/")]).collect()}
    assert got["far.d"].verdict == "block" and abs(got["far.d"].distrust - 0.15 * 0.85**2) < 1e-9


def test_every_host_seeds_by_its_share_and_by_links(spark):
    pages = [(i, f"http://part.a/{'de' if i < 4 else 'en'}/{i}", "") for i in range(10)]
    pages += [page(20, "to-part.b", "http://part.a/de/1"), page(21, "to-spam.c", "http://spam.net/x", "//Sub.Spam.net/y")]
    pages += [page(22, "to-mixed.d", "http://mixed.e/bad/1?q", "http://mixed.e/")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = [("block", "part.a", "/de/"), ("block", "net", "/"), ("block", "mixed.e", "/bad/")]
    got = {r.host: r for r in url_trust.url_verdicts(df, rules).collect()}
    assert abs(got["part.a"].distrust - 0.15 * 0.4) < 1e-9
    # By links, spam.net and sub.spam.net are seeds of 1, mixed.e of one half.
    for host, mass in (("to-part.b", 0.4), ("to-spam.c", 2.0), ("to-mixed.d", 0.5)):
        assert abs(got[host].distrust - 0.15 * 0.85 * mass) < 1e-9
        assert got[host].verdict == "block"


def test_odd_rows(spark):
    odd = [(1, None, None), (1, None, None), (2, "no scheme", "x"), (3, "http://", ""), (None, "HTTP://A.Net?x", "<a href=>"), (5, "x://É.net/#/en/", None), (6, "http://a.net/é", "<a href='http://b.net' href=http://c.org>" * 50)]
    df = spark.createDataFrame([(*r, k, 0.5) for k, r in enumerate(odd)], "page_id long, url string, html string, n_pages int, trust double")
    got = url_trust.url_verdicts(df, RULES).collect()
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == sorted(
        (str(i), *parts(u), str(rule_of(*parts(u), RULES)[0])) for i, u, _ in odd
    )
    assert url_trust.url_verdicts(df.filter("page_id = -1"), RULES).collect() == []


def test_plan_has_no_python(spark):
    plan = QUERIES["op2_link_trust"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
