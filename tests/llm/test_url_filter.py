import pytest

from corpusloom.llm import url_filter as uf
from corpusloom.llm.queries import URL_RULES
from tests.conftest import rows

PAGES = "page_id bigint, url string, html string, verdict string"


def link(*hosts):
    return "".join(f'<a href="https://{h}/x">y</a>' for h in hosts)


def test_rules(spark):
    cases = {
        "https://a.COM/": ("a.com", "/", "com/", "allow"), "https://a.com": ("a.com", "", None, "allow"),
        "http://www.example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://m.example.com/en/1": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "x://net/es/a": ("net", "/es/a", "net/es/", "block"), "x://a.net?q=/fr/": ("a.net", "", None, "allow"),
        "x://a.net#/fr/": ("a.net", "", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "a://b://c": ("b:", "//c", None, "allow"), "://": ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, None, "z") for i, u in enumerate(cases)], PAGES)
    assert [r[1:] for r in sorted(map(tuple, uf.url_verdicts(df, URL_RULES).collect()))] == list(cases.values())


def ranks(nodes, edges, seed, rounds=uf.ROUNDS):
    out = {n: sum(a == n for a, _ in edges) for n in nodes}
    t, p = dict(seed), dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        t, p = ({n: 0.15 * s.get(n, 0) + 0.85 * sum(v[a] / out[a] for a, b in edges if b == n) for n in nodes}
                for s, v in ((seed, t), (dict.fromkeys(nodes, 1.0), p)))
    return {n: t[n] / p[n] for n in nodes}


def test_scores_equal_brute_force(spark):
    nodes = list("abcdefg")
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "d"), ("e", "a"), ("f", "e")]
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("d", 0.0, 0.75), ("g", 0.5, 0.5)], "host string, good double, bad double")
    got = {r.host: r for r in uf.host_scores(seeds, spark.createDataFrame(edges, "src string, dst string")).collect()}
    trust = ranks(nodes, edges, {n: {"a": 1.0, "g": 0.5}.get(n, 0.0) for n in nodes})
    distrust = ranks(nodes, [(b, a) for a, b in edges], {n: {"d": 0.75, "g": 0.5}.get(n, 0.0) for n in nodes})
    for n in nodes:
        assert got[n].trust == pytest.approx(trust[n], abs=1e-8) and got[n].distrust == pytest.approx(distrust[n], abs=1e-8)


def test_distrust_flows_back_and_trust_forward(spark):
    df = spark.createDataFrame([
        (1, "https://spam.net/es/", "", None), (2, "https://farm.org/a", link("spam.net", "SPAM.net"), None),
        (3, "https://good.com/a", link("friend.org", "good.com"), None), (4, "https://friend.org/a", link("spam.net", "good.com"), None),
        (5, "https://alone.org/a", None, None), (6, "https://spam.net/en/", "", None), (6, "https://spam.net/en/", "", None),
    ], PAGES)
    got = {(r.page_id): r.verdict for r in uf.url_verdicts(df, URL_RULES, threshold=0.09).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}


def test_farms_are_blocked_at_the_registered_threshold(spark):
    """Farms of several in-degrees, a host before a farm, and hosts that only brush a blocked one."""
    pages = []
    for n in (1, 2, 3, 10):
        spam = [f"spam{i}-{n}.net" for i in range(n)]
        pages += [(f"https://{h}/es/", "", "block") for h in spam]
        pages += [(f"https://farm{i}-{n}.org/", link(*spam), "block") for i in range(n)]  # as many farms as targets
        pages += [(f"https://many{i}-{n}.org/", link(f"hub-{n}.net"), "block") for i in range(n)]  # one target
        pages += [(f"https://hub-{n}.net/fr/", "", "block"), (f"https://before-{n}.org/", link(f"farm0-{n}.org"), "block")]
    pages += [("https://brushed.net/es/", "", "block"),
              ("https://blog.org/", link("brushed.net", *(f"plain{i}.org" for i in range(4))), "allow"),
              ("https://part.net/es/", "", "block"), *[("https://part.net/", link("plain0.org"), "allow")] * 9]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], PAGES)
    got = {r.page_id: r.verdict for r in uf.url_verdicts(df, URL_RULES).collect()}
    assert {p[0]: got[i] for i, p in enumerate(pages)} == {p[0]: p[2] for p in pages}


def test_distrusted_takes_the_mean_of_links_for_unruled_pages(spark):
    seeds = spark.createDataFrame(
        [("s", 0.0, 1.0), ("a", 0.0, 0.0), ("b", 0.0, 0.0), ("c", 1.0, 0.0), ("m", 0.0, 0.1), ("n", 0.0, 0.1)],
        "host string, good double, bad double")
    edges = [("a", "s"), ("b", "a"), ("c", "s"), ("m", "s"), ("n", "x")]
    got = {r.host: r for r in uf.host_scores(seeds, spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert [got[h].distrusted for h in "sabmx"] == [1, 1, 1, 1, 0]
    assert got["c"].distrusted == got["c"].distrust < 0.5 and got["n"].distrusted < 0.1
    assert all(r.distrusted >= r.distrust for r in got.values())


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], PAGES)
    assert uf.url_verdicts(empty, URL_RULES).count() == 0
    plan = uf.url_verdicts(empty, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
