"""URL rules against trying every rule on every URL."""

import re

import pytest
from pyspark.sql import functions as F

from prosemill.llm import url_rules
from prosemill.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"
URLS = [
    "http://EXAMPLE.org/es/", "http://www.example.org/en/12?x#y", "https://a.b.example.org/en/2", "http://org/", "http://org",
    "http://x.com/fr/a", "http://x.com/de/", "http://x.com/de", "http://com/fr/", "http://notcom/fr/", "http://xcom/de/a",
    "http://example.org:80/es/", "http://example.org?/es/", "http://example.org#a/es/", "x://y://example.org/es/", "://com/de/",
    "example.org/es/", "", None, "http://", "http:///es/", "http://a..org/", "http://.org/x", "http://É.ORG/\nes/", "http://a.com/fr/" + "x" * 5000,
    "http://www.example.org/en/1", "http://www.example.org/en/1", "HTTP://Ä.Com/DE/",
]


def direct(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a, h + p) for h, p, a in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


@pytest.mark.parametrize("rules", [
    URL_RULES, [], URL_RULES + [("", "/", "block"), ("a.b.example.org", "/", "block"), ("org", "/", "block"), ("x.com", "", "block")],
])
def test_against_every_rule(shared, rules):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://x.com/de/", None)]
    pages = shared.createDataFrame(rows, PAGES).withColumn("prefix", F.lit("p")).repartition(3)
    table = url_rules.rule_table(shared, rules)
    used = {}
    for h, p, a in rules:
        used[(h, p)] = max(a, used.get((h, p), a))
    flat = [(h, p, a) for (h, p), a in used.items()]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, table).collect()), key=str)
    assert got == sorted(((i, *direct(u, flat)) for i, u, _ in rows), key=str)


def test_default_and_nothing(shared):
    pages = shared.createDataFrame([(1, "http://a.net/", "")], PAGES)
    table = url_rules.rule_table(shared, URL_RULES)
    assert url_rules.judge(pages, table, default="block").first().verdict == "block"
    assert url_rules.judge(pages.limit(0), table).count() == 0


def test_columns_of_any_name(shared):
    """Columns named as results give way to them; all others travel along."""
    names = ["best", "_cut", "__best", "host", "path", "rule", "verdict", "prefix", "digest", "rule_host", "a.b"]
    rows = [(i, u, *["clash"] * len(names)) for i, u in enumerate(URLS)]
    schema = "page_id long, url string, " + ", ".join(f"`{n}` string" for n in names)
    for rules in (URL_RULES, []):
        table = url_rules.rule_table(shared, rules)
        got = url_rules.judge(shared.createDataFrame(rows, schema), table)
        kept = [n for n in names if n not in url_rules.RESULTS]
        assert got.columns == ["page_id", "url", *kept, *url_rules.RESULTS]
        plain = url_rules.judge(shared.createDataFrame([r[:2] for r in rows], "page_id long, url string"), table)
        want = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in plain.collect()}
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == want
        assert got.where("best <> 'clash' or `a.b` <> 'clash'").count() == 0
