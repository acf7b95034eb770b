import fixtures as f
import pytest

from orebelt.llm import host_rank
from orebelt.llm.host_rank import Rule

RULES = [Rule("allow", "org", "/"), Rule("block", "bad.net", ""), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1")]


def pages(spark, rows):
    return f.table(spark, rows, "page_id bigint, url string, html string")


def link(*hosts):
    return "".join(f'<a HREF="https://{h}/x">y</a>' for h in hosts)


def test_rules_and_parts(spark):
    urls = {
        1: "https://WWW.Example.ORG/es/1?q=/es/#x",
        2: "http://example.org/en/17",
        3: "https://notexample.org/es/1",
        4: "https://org",
        5: "no url",
        6: None,
        7: "x://a.bad.net?q",
        8: "x://badxnet/",
        9: "https://example.org#/es/",
    }
    got = {r.page_id: tuple(r)[1:] for r in host_rank.judge_urls(pages(spark, [(i, u, "") for i, u in urls.items()]), RULES).collect()}
    assert got[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[3] == ("notexample.org", "/es/1", "org/", "allow")
    assert got[4] == ("org", "", None, "allow")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7] == ("a.bad.net", "", "bad.net", "block")
    assert got[8] == ("badxnet", "/", None, "allow")
    assert got[9] == ("example.org", "", None, "block")  # no rule fits, and all its ruled pages are blocked


def brute(rows, damping, iterations):
    """Personalised PageRank both ways over the same seeds."""
    out = {}
    for src, dst in rows["links"]:
        out.setdefault(src, set()).add(dst)
    back = {}
    for src, dsts in out.items():
        for dst in dsts:
            back.setdefault(dst, set()).add(src)
    ranks = []
    for ways, seeds in ((out, rows["trust"]), (back, rows["distrust"])):
        rank = dict(seeds)
        for _ in range(iterations):
            new = {h: (1 - damping) * s for h, s in seeds.items()}
            for src, r in rank.items():
                for dst in ways.get(src, ()):
                    new[dst] = new.get(dst, 0) + damping * r / len(ways[src])
            rank = new
        ranks.append(rank)
    return ranks


def test_propagation_against_brute_force(spark):
    rows = [
        (1, "https://good.org/", link("a.net", "b.net", "good.org")),
        (2, "https://a.net/", link("c.net") + '<a href="/relative">r</a><a href=//D.net/p>p</a>'),
        (3, "https://spam.net/", link("bad.net", "c.net")),
        (4, "https://c.net/", link("spam.net")),
        (5, "https://bad.net/", link("a.net")),
        (6, "https://d.net/", None),
        (7, "https://alone.net/", "<p>no links</p>"),
        (8, "https://a.net/2", link("c.net")),
    ]
    links = {("good.org", "a.net"), ("good.org", "b.net"), ("a.net", "c.net"), ("a.net", "d.net"), ("spam.net", "bad.net"), ("spam.net", "c.net"), ("c.net", "spam.net"), ("bad.net", "a.net")}
    table = pages(spark, rows)
    assert set(f.rows(host_rank.host_links(table, "url", "html"))) == links
    trust, distrust = brute({"links": links, "trust": {"good.org": 1.0}, "distrust": {"bad.net": 1.0}}, 0.85, 10)
    got = {r.page_id: r for r in host_rank.judge_urls(table, RULES).collect()}
    for page, url, _ in rows:
        host = got[page].host
        if got[page].rule is None:
            expected = "block" if distrust.get(host, 0) > trust.get(host, 0) else "allow"
            assert got[page].verdict == expected, host
    assert got[3].verdict == "block" and got[6].verdict == "allow" and got[7].verdict == "allow"
    rank = host_rank.propagate(host_rank.host_links(table, "url", "html"), spark.createDataFrame([("trust", "good.org", 1.0), ("distrust", "bad.net", 1.0)], "kind string, host string, seed double"))
    for r in rank.collect():
        assert r["rank"] == pytest.approx((trust if r.kind == "trust" else distrust)[r.host])


def test_chain_of_more_than_ten_hosts(spark):
    hosts = [f"h{i}.net" for i in range(14)]
    rows = [(i, f"https://{h}/", link(after)) for i, (h, after) in enumerate(zip(hosts, hosts[1:] + ["bad.net"]))]
    rows += [(90, "https://bad.net/", ""), (91, "https://else.net/", link("other.net"))]
    got = {r.page_id: r.verdict for r in host_rank.judge_urls(pages(spark, rows), RULES).collect()}
    assert got == {i: "block" for i in range(14)} | {90: "block", 91: "allow"}


def test_ranks_are_those_of_the_page_rank(spark):
    pairs = {("good.org", "a.net"), ("a.net", "b.net"), ("b.net", "good.org"), ("b.net", "bad.net"), ("bad.net", "a.net")}
    trust, distrust = brute({"links": pairs, "trust": {"good.org": 1.0}, "distrust": {"bad.net": 1.0}}, 0.85, 300)
    links = spark.createDataFrame(sorted(pairs), "src string, dst string")
    seeds = spark.createDataFrame([("trust", "good.org", 1.0), ("distrust", "bad.net", 1.0)], "kind string, host string, seed double")
    rank = host_rank.propagate(links, seeds, iterations=None).collect()
    assert len(rank) == len(trust) + len(distrust)
    for r in rank:
        assert r["rank"] == pytest.approx((trust if r.kind == "trust" else distrust)[r.host], rel=1e-4)


def test_sql_over_pages_that_link_to_other_hosts(spark, tmp_path):
    """The graph decides here, also for hosts that many steps lead to."""
    import random

    import duckdb

    from orebelt.llm import sql

    pick = random.Random(4)
    hosts = [f"h{i}.net" for i in range(40)] + ["good.org", "fine.org", "bad.net", "x.bad.net"]
    chain = {f"h{i}.net": [f"h{i + 1}.net"] for i in range(12)}
    rows = []
    for i, host in enumerate(hosts * 2):
        others = chain.get(host, []) + pick.sample(hosts, pick.randint(0, 3))
        rows.append((i, f"https://{host}/{i}", link(*others)))
    rows += [(900, None, link("h1.net")), (901, "https://lonely.net/", None), (901, "https://lonely.net/", None)]
    got = f.rows(host_rank.judge_urls(pages(spark, rows), RULES))
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(con.execute(sql.host_rank(RULES)).fetchall(), key=repr)
    verdicts = {v for *_, rule, v in got if rule is None}
    assert verdicts == {"allow", "block"}


def test_empty_table(spark):
    assert host_rank.judge_urls(pages(spark, []).limit(0), RULES).count() == 0
