"""Hosts, paths and rules by a plain reading; templates against SQL and a planted site."""

import duckdb
import inputs
import pandas as pd

from ledgerloom.llm import urls


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)).name if fits else None


def addresses():
    return [None, "", "x", "http://", "http://a.COM", "http://a.com/", "https://WWW.example.com/en/1?x=/y#z", "http://www.example.com/en",
            "ftp://example.com/en/a/b/c/d/e/f", "http://é.net/fr/1", "http://net/es/", "http://a.net/es?x", "http://xnet/es/",
            "a://b://c.net/fr/x", "http://h.org//a//b/", "http://h.org/a/b\nc", "http://com/", "http://u@a.com:80/x",
            "http://h.org#/x", "http://h.org?a/b", *[f"http://big.org/p{chr(97 + i % 26)}{chr(97 + i // 26)}q/{i}" for i in range(80)]]


def test_base_columns(spark):
    rows = [(i, u, None) for i, u in enumerate(addresses())]
    got = {r.page_id: r for r in urls.filtered(inputs.pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, url, _ in rows:
        assert (got[i].host, got[i].path, got[i].rule) == plain(url)
        assert got[i].verdict in ("allow", "block")
        if got[i].rule:
            assert got[i].verdict == next(r.verdict for r in urls.RULES if r.name == got[i].rule)
    # More than fifty rare siblings are one wildcard.
    assert got[len(rows) - 1].template == "/*/*"


def test_sql_gives_the_same(spark):
    rows = [(i, u, None) for i, u in enumerate(addresses() * 2)]
    con = duckdb.connect()
    con.register("frame", pd.DataFrame({"page_id": range(len(rows)), "url": [u for _, u, _ in rows]}))
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    names = "page_id, host, path, rule, verdict, template"
    want = con.sql(f"SELECT {names} FROM ({urls.oracle()}) ORDER BY page_id").fetchall()
    got = urls.filtered(inputs.pages(spark, rows)).select(*names.split(", ")).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want


def test_a_bad_branch_is_blocked_and_its_sibling_is_not(spark):
    rules = (urls.Rule("block", "h.org", "/bad/a"), urls.Rule("allow", "h.org", "/good/a"), urls.Rule("allow", "h.org", "/fine/a"))
    paths = [f"/{kind}/{name}{i}" for kind in ("bad", "good", "fine") for name in ("a", "b") for i in range(30)]
    rows = [(i, f"http://h.org{p}", None) for i, p in enumerate(paths)]
    got = {paths[r.page_id]: r.verdict for r in urls.filtered(inputs.pages(spark, rows), rules).collect()}
    assert all(v == ("block" if p.startswith("/bad") else "allow") for p, v in got.items())


def test_branches_without_labels_keep_their_shape_and_borrow_it(spark):
    rules = (urls.Rule("block", "a.org", "/bad"), urls.Rule("allow", "a.org", "/good"))
    paths = [f"http://{host}/{kind}/{i}" for host in ("a.org", "b.org") for kind in ("bad", "good", "other") for i in range(20)]
    got = [(paths[r.page_id], r) for r in urls.filtered(
        inputs.pages(spark, [(i, u, None) for i, u in enumerate(paths)]), rules).collect()]
    assert {r.template for u, r in got if "b.org" in u} == {"/bad/*", "/good/*", "/other/*"}
    assert all((r.verdict == "block") == ("/bad/" in u) for u, r in got if "/other/" not in u)


def test_like_branches_with_labels_merge(spark):
    rules = (urls.Rule("block", "a.org", "/x"), urls.Rule("allow", "a.org", "/y"))
    paths = [f"/{kind}{name}/{'abcde'[i % 5]}" for kind, name in (("x", "p"), ("x", "q"), ("y", "p"), ("y", "q")) for i in range(40)]
    got = urls.filtered(inputs.pages(spark, [(i, f"http://a.org{p}", None) for i, p in enumerate(paths)]), rules).collect()
    # Leaves of a branch are alike; the branches themselves are not.
    assert {r.template for r in got} == {"/xp/*", "/xq/*", "/yp/*", "/yq/*"}


def test_long_paths(spark):
    pages = inputs.pages(spark, [(1, "http://a.org/" + "x/" * 20_000, None), (2, "http://net/es/" + "y" * 50_000, None)])
    got = {r.page_id: r for r in urls.filtered(pages).collect()}
    assert got[1].template == "/x/x/x/x/**" and got[2].verdict == "block"


def test_no_rows_and_repeated_rows(spark):
    pages = inputs.pages(spark, [(1, "http://a.org/x", None)] * 3 + [(None, None, None)])
    assert urls.filtered(pages).count() == 4 and urls.filtered(pages.limit(0)).count() == 0
