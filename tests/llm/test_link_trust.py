"""Verdicts on urls against a plain version, and against the SQL, on pages that link to each other."""

import random
import re
from collections import Counter

import duckdb
import pytest

from fieldwatch.llm import common, link_trust

NAMES = ["a.net", "b.net", "c.net", "www.d.net", "farm.example.org", "shop.com", "good.com", "org", "x.org", "example.org"]


def made(seed: int, n: int) -> list[tuple]:
    chance, rows = random.Random(seed), []
    for k in range(n):
        host = chance.choice(NAMES)
        links = "".join(
            chance.choice(['<a href="http://{}/p">', "<A class=x HREF = '//{}?q'>", "<a\thref=https://{}#f>", '<a data-href="http://no.net">', '<a title="{}" rel=x>', '<link href="http://no.org/">']).format(chance.choice(NAMES).upper()) + "t</a>"
            for _ in range(chance.randrange(4))
        )
        rows.append((k, f"http://{host}{chance.choice(['', '/', '/fr/1', '/de/2', '/es/3', '/en/1', '/en/12?x=/de/', '/en/2#top'])}", f"<body>{links}</body>"))
    return rows


CORNERS = [
    (900, None, None), (901, "", ""), (902, "no host", '<a href="http://a.net">'), (903, "HTTP://EXAMPLE.ORG/es/x", None), (904, "x://http://org/", "<a " * 30_000), (905, "ftp://sub.example.org/en/19?a#b", "<a href='//b.net'>"),
    (906, "://com/de/", ""), (907, "http://org", ""), (908, "http://notorg/", "<a href=//" + "z" * 100_000 + ">"), (909, "http://xcom/fr/", ""), (None, "http://a.net/", '<a href="http://shop.com/">'), (910, "http://com?/de/", ""), (910, "http://com?/de/", ""),
]


def plain(rows, rounds=20):
    def parsed(url):
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")

    def rule(host, path):
        fits = [(len(r), r, v) for v, r in link_trust.RULES if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
        return max(fits)[1:] if fits else (None, None)

    links, seeds = Counter(), {"trust": Counter(), "distrust": Counter()}
    for _, url, html in rows:
        host, path = parsed(url)
        if v := rule(host, path)[1]:
            seeds["trust" if v == "allow" else "distrust"][host] += 1_000_000
        for tag in re.findall(r"<a\s[^<>]*>", html or "", re.I):
            m = re.search(r"""\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]+)""", tag, re.I)
            if m and host and m[1].lower() != host:
                links[host, m[1].lower()] += 1
    scores = {}
    for kind, edges in (("trust", links), ("distrust", Counter({(b, a): w for (a, b), w in links.items()}))):
        whole, now = Counter(), seeds[kind]
        for (a, _), w in edges.items():
            whole[a] += w
        for _ in range(rounds):
            moved = Counter()
            for (a, b), w in edges.items():
                moved[b] += now[a] * w // whole[a]
            now = Counter({h: 85 * x // 100 for h, x in moved.items()}) + Counter({h: 15 * x // 100 for h, x in seeds[kind].items()})
        scores[kind] = now
    out = []
    for i, url, _ in rows:
        host, path = parsed(url)
        r, v = rule(host, path)
        out.append((i, host, path, r, v or ("block" if scores["distrust"][host] > scores["trust"][host] else "allow")))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_linked_pages(spark, tmp_path, seed):
    rows = made(seed, 300) + CORNERS
    pages = spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], "page_id bigint, url string, html string, host string, score bigint, verdict string").repartition(3)
    want = plain(rows)
    assert result(link_trust.verdicts(pages)) == want
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}
    pages.coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    assert sorted(con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({link_trust.VERDICTS_SQL})").fetchall(), key=repr) == want


def test_distrust_runs_against_links_and_trust_along_them(spark):
    rows = [(1, "http://x.org/", '<a href="http://liked.net/">'), (2, "http://liked.net/", ""), (3, "http://bad.com/de/", '<a href="http://victim.net/">'), (4, "http://victim.net/", ""), (5, "http://promoter.net/", '<a href="http://bad.com/de/">')]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.host: (r.trust > 0, r.distrust > 0) for r in link_trust.host_scores(pages).collect()}
    assert got == {"x.org": (True, False), "liked.net": (True, False), "bad.com": (False, True), "promoter.net": (False, True)}
    assert {r.page_id: r.verdict for r in link_trust.verdicts(pages).collect()} == {1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "block"}


def test_given_and_empty_tables(spark, sf_dir):
    common.ship(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert result(link_trust.verdicts(pages)) == plain([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert link_trust.verdicts(pages.limit(0)).count() == 0
