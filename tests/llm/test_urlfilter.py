"""URL parts, rules and propagation against plain versions."""

from __future__ import annotations

import re

import pytest

from churnlens.checks.compare import compare, duckdb_views
from churnlens.llm import urlfilter
from churnlens.llm.queries import ORACLE, QUERIES, URL_RULES
from tests.conftest import SF_SMALL
from tests.llm.helpers import pages, tuples

URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://www.example.org/en/12?x#y", "http://example.org/en/2",
        "http://notexample.org/es/1", "http://x.com/fr/", "http://x.com/fr", "http://com/de/1", "x.com://y.com/de/://z", "a://b?c/d",
        "a://b#c", "http://É.com/de/", "http://x.com/de/a\nb", "http://x.com//fr/", "http://ORG/", "http://x.org"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    found = [(len(r), r, v) for r, v in URL_RULES
             if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(found)[1:] if found else (None, None)


def test_parts_and_rules(spark):
    got = urlfilter.judge_urls(pages(spark, [(k, u, None) for k, u in enumerate(URLS)] + [(0, None, "x"), (None, URLS[4], "")]), URL_RULES)
    want = []
    for k, u in [*enumerate(URLS), (0, None), (None, URLS[4])]:
        host, path = plain_parts(u)
        rule, verdict = plain_rule(host, path)
        want.append((k, host, path, rule, verdict))
    assert [r[:4] for r in tuples(got, "page_id", "host", "path", "rule", "verdict")] == sorted([w[:4] for w in want], key=repr)
    for r in got.collect():
        fit = plain_rule(r.host, r.path)[1]
        assert fit in (None, r.verdict) and r.verdict in ("allow", "block")
        assert r.host or r.verdict == "allow"


def link(*targets):
    return "".join(f"<a href='{t}'>x</a>" for t in targets)


def plain_ranks(rows, rules, iterations=400, d=0.85):
    """Both propagations over dictionaries, to their fixed points."""
    edges, seeds = {}, {"trust": {}, "distrust": {}}
    for _, url, html in rows:
        src, path = plain_parts(url)
        for t in re.findall(urlfilter.LINK, html or ""):
            if re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", t):
                dst = plain_parts("x:" + t if t.startswith("//") else t)[0]
                if src and dst and src != dst:
                    edges[src, dst] = edges.get((src, dst), 0) + 1
        found = [(len(r), v) for r, v in rules if (src == r.split("/")[0] or src.endswith("." + r.split("/")[0]))
                 and path.startswith("/" + r.split("/", 1)[1])]
        if found and src:
            kind = "trust" if max(found)[1] == "allow" else "distrust"
            seeds[kind][src] = seeds[kind].get(src, 0) + 1
    out = {}
    for kind, flip in (("trust", False), ("distrust", True)):
        steps = {((b, a) if flip else (a, b)): w for (a, b), w in edges.items()}
        total = {}
        for (a, _), w in steps.items():
            total[a] = total.get(a, 0) + w
        start = {h: (1 - d) * s for h, s in seeds[kind].items()}
        rank = dict(start)
        for _ in range(iterations):
            new = dict(start)
            for (a, b), w in steps.items():
                if a in rank:
                    new[b] = new.get(b, 0) + d * rank[a] * w / total[a]
            rank = new
        out[kind] = rank
    return out


LINKED = [(1, "http://good.org/a", link("http://mid.net/x", "//far.net/", "/own", "http://GOOD.org/b")),
          (2, "http://mid.net/1", link("http://far.net/1", "http://far.net/2", "http://spam.com/de/1")),
          (3, "http://far.net/1", link("http://good.org/")), (4, "http://spam.com/de/9", link("http://pal.net/")),
          (5, "http://fan.net/1", link("http://spam.com/x", "http://spam.com/y")), (6, "http://pal.net/1", ""),
          (7, "http://fan.net/2", None), (8, "http://spam.com/de/7", "<A HREF = \"http://fan.net\">"), (9, "http://alone.net", "")]


def test_propagation_equals_a_plain_version(spark):
    got = {r.host: r for r in urlfilter.judge_urls(pages(spark, LINKED), URL_RULES).collect()}
    ranks = plain_ranks(LINKED, URL_RULES)
    for host, r in got.items():
        assert r.trust == pytest.approx(ranks["trust"].get(host, 0), rel=2e-6)
        assert r.distrust == pytest.approx(ranks["distrust"].get(host, 0), rel=2e-6)
        if r.rule is None:
            blocked = r.distrust > 0 and r.distrust >= 2 * r.trust
            assert r.verdict == ("block" if blocked else "allow")
    assert got["fan.net"].verdict == "block" and got["far.net"].verdict == "allow" and got["alone.net"].verdict == "allow"
    assert got["fan.net"].distrust > 0 and got["mid.net"].trust > 0


def test_a_chain_of_twenty_hops_ends_blocked(spark):
    """Distrust reaches the first host of a chain of links to a blocked one, however long."""
    rows = [(k, f"http://h{k}.net/", link(f"http://h{k + 1}.net/")) for k in range(20)]
    rows += [(20, "http://h20.net/", link("http://bad.com/de/1")), (21, "http://bad.com/de/1", "")]
    verdict = {r.host: (r.verdict, r.distrust) for r in urlfilter.judge_urls(pages(spark, rows), URL_RULES).collect()}
    assert all(v == "block" for v, _ in verdict.values()) and 0 < verdict["h0.net"][1] < verdict["h19.net"][1]


def test_ranks_behind_two_wide_fans_count(spark):
    """A hub with 20,000 links in, behind another such hub, has a rank of about 1e-10 and its verdict."""
    n = 20_000
    seeds = spark.createDataFrame([("distrust", "bad", 1.0)], "kind string, host string, seed double")
    wide = spark.range(n).selectExpr("concat('a', id) AS src", "'hub' AS dst", "1D AS weight")
    wide = wide.unionByName(spark.range(n).selectExpr("concat('b', id) AS src", "'bad' AS dst", "1D AS weight"))
    wide = wide.unionByName(spark.sql("SELECT 'hub' AS src, 'bad' AS dst, 1D AS weight"))
    ranks = {(r.kind, r.host): r["rank"] for r in urlfilter.propagate(seeds, wide).collect()}
    one = 0.15 * 0.85 / (n + 1)
    assert ranks["distrust", "hub"] == pytest.approx(one) and ranks["distrust", "a7"] == pytest.approx(one * 0.85 / n)
    judged = urlfilter.host_verdicts(spark.createDataFrame([(k, h, r) for (k, h), r in ranks.items()], "kind string, host string, rank double"))
    assert judged.filter("blocked").count() == 2 * n + 2


def test_a_hub_is_split_over_tasks(spark):
    """Both inputs of a round's join are plain scans, so the skew join can split a hub's links."""
    import contextlib
    import io
    edges = spark.range(60_000).selectExpr("concat('x', id) AS dst", "'hub' AS src", "1D AS weight")
    seeds = spark.createDataFrame([("trust", "hub", 1.0)], "kind string, host string, seed double")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        from churnlens.llm.common import written
        both = written(edges.selectExpr("'trust' AS kind", "src AS host", "dst", "weight AS share"), "t")
        state = written(seeds.selectExpr("kind", "host", "seed AS rank"), "t")
        flow = state.join(both, ["kind", "host"])
        flow.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            flow.explain()
        assert "skew=true" in out.getvalue()
        assert len(urlfilter.propagate(seeds, edges).collect()) == 60_001
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_oracle_on_linked_pages(spark, tmp_path):
    import duckdb

    table = pages(spark, LINKED).select("page_id", "url", "html")
    con = duckdb.connect()
    con.register("pages", table.toPandas())
    got = urlfilter.judge_urls(table, URL_RULES).drop("trust", "distrust").toPandas()
    status, detail = compare(got, con.sql(ORACLE["op9_url_filter"]).df())
    assert status == "OK", detail


def test_no_python_in_the_plans(spark):
    import contextlib
    import io
    for name in ("op9_url_filter", "op4_mixing"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            QUERIES[name](spark, SF_SMALL).explain()
        assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue() and "Cartesian" not in out.getvalue()


def test_empty_table(spark):
    assert urlfilter.judge_urls(pages(spark, []), URL_RULES).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    status, detail = compare(QUERIES[name](spark, SF_SMALL).toPandas(), duckdb_views(SF_SMALL).sql(ORACLE[name]).df())
    assert status == "OK", detail
