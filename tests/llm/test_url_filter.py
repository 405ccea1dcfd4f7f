import random

import numpy as np
import pytest

from utterflow.llm import url_filter as uf


def pages(spark, rows):
    rows = [(i, u, h) for i, (u, h) in enumerate(rows)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        (None, "", "", None, None),
        ("no scheme", "", "", None, None),
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://a.example.net/EN/x", "a.example.net", "/EN/x", "net/", "block"),
        ("http://net", "net", "", None, None),
        ("http://net/", "net", "/", "net/", "block"),
        ("x://planet/", "planet", "/", None, None),
        ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
        ("http://myexample.com/de/1", "myexample.com", "/de/1", None, None),
        ("http://b.org/fr/?://x/y", "b.org", "/fr/", "org/fr/", "allow"),
        ("http://b.org?/fr/", "b.org", "", None, None),
        ("http://b.org#x", "b.org", "", None, None),
        ("a\n://ÉA.org/fr/\n1", "Éa.org", "/fr/\n1", "org/fr/", "allow"),
        ("://x/y://z", "x", "/y://z", None, None),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    (row,) = uf.with_rules(pages(spark, [(url, None)])).collect()
    assert (row.host, row.path, row.rule, row.rule_verdict) == (host, path, rule, verdict)


def test_links_of_pages(spark):
    page = '<a HREF="http://B.com/x">1</a><a href=//c.com>2</a><a href="/own">3</a><a href="http://b.com/x">4</a>'
    rows = [("http://a.com/", page), ("http://a.com/2", page), (None, page), ("http://b.com", page), ("http://a.com", None)]
    found = {(r.src, r.dst): r.n for r in uf.host_links(pages(spark, rows)).collect()}
    assert found == {("a.com", "b.com"): 4, ("a.com", "c.com"): 2, ("b.com", "c.com"): 1}


def test_spread_is_personalised_pagerank(spark):
    rng = random.Random(1)
    n = 12
    edges = [(f"h{rng.randrange(n - 2)}", f"h{rng.randrange(n)}", rng.randrange(1, 4)) for _ in range(30)]
    edges = list({(a, b): (a, b, k) for a, b, k in edges if a != b}.values())
    seeds = [("h0", 2.0), ("h3", 1.0), ("h11", 0.0)]
    result = dict(
        uf.spread(
            spark.createDataFrame(edges, "src string, dst string, n long"),
            spark.createDataFrame(seeds, "host string, weight double"),
            iterations=60,
            tolerance=1e-9,
        ).collect()
    )
    seed = np.zeros(n)
    seed[0], seed[3] = 2 / 3, 1 / 3
    move = np.zeros((n, n))
    for a, b, k in edges:
        move[int(b[1:]), int(a[1:])] = k
    out = move.sum(axis=0)
    move = move / np.where(out, out, 1)
    rank = seed.copy()
    for _ in range(200):
        flow = uf.DAMPING * move @ rank
        rank = flow + (1 - flow.sum()) * seed
    for i in range(n):
        assert result.get(f"h{i}", 0.0) == pytest.approx(rank[i], abs=1e-6)


def test_verdicts_follow_links(spark):
    to = lambda *hosts: "".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [
        ("http://good.org/fr/1", to("friend.com")),
        ("http://bad.net/x", to("friend.com")),
        ("http://shady.com/1", to("bad.net", "bad.net")),
        ("http://friend.com/1", to("good.org")),
        ("http://alone.com/1", None),
        (None, None),
    ]
    found = {r.host: r.verdict for r in uf.judged_urls(pages(spark, rows)).collect()}
    assert found == {
        "good.org": "allow", "bad.net": "block", "shady.com": "block", "friend.com": "allow",
        "alone.com": "allow", "": "allow",
    }


def test_no_seeds_no_links_and_no_rows(spark):
    assert [r.verdict for r in uf.judged_urls(pages(spark, [("http://x.com/", None)])).collect()] == ["allow"]
    assert uf.judged_urls(pages(spark, [])).count() == 0


def test_repeated_rows_and_clashing_columns(spark):
    table = spark.createDataFrame(
        [(1, "http://a.net/", "", "h", "allow"), (1, "http://a.net/", "", "h", "allow")],
        "page_id long, url string, html string, host string, verdict string",
    )
    assert [tuple(r) for r in uf.judged_urls(table).collect()] == [(1, "a.net", "/", "net/", "block")] * 2


def test_a_partly_blocked_host_spreads_its_share_of_distrust(spark):
    to = lambda *hosts: "".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [(f"http://example.com/de/{i}", None) for i in range(49)]
    rows += [(f"http://example.com/x{i}", None) for i in range(51)]
    rows += [("http://linker.io/1", to("example.com")), ("http://other.io/1", None)]
    found = {(r.host, r.verdict) for r in uf.judged_urls(pages(spark, rows)).collect()}
    assert ("linker.io", "block") in found and ("other.io", "allow") in found


def test_iterations_reach_the_tolerance():
    assert uf.DAMPING ** uf.ITERATIONS <= uf.TOLERANCE < uf.DAMPING ** (uf.ITERATIONS - 1)
