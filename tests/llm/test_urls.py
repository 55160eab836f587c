import pytest

from tessera.llm import urls
from tessera.llm.queries import BLOCKED_LABELS, URL_RULES
from tests.llm.helpers import got

URLS = ["http://a.net/x", "http://A.Example.NET/en/1?q", "https://example.net/en", "https://example.net/en/", "ftp://net/",
        "http://net", "http://planet/", "http://b.example.com/de/x#y", "http://badexample.com/de/x", "http://x.org/fr/1",
        "http://x.org/fr", "http://spam-farm.example.org/en/1", "http://spam-farm.example.net/x", "no scheme/en/", "", None,
        "http://", "x://h?p/en/", "http://h#/f/", "http://a..net/", "http://\u00c4.NET/\u00df", "http://a.net/x", "://n.net/://z"]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        path = rest[at:]
        path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    if best:
        return host, path, *best
    return host, path, None, "block" if set(host.split(".")) & set(BLOCKED_LABELS) else "allow"


@pytest.mark.parametrize("most_bits", [urls.MOST_BITS, 2048])
def test_verdicts(spark, monkeypatch, most_bits):
    """With short filters the list of hosts is split, and cascades judge its parts."""
    monkeypatch.setattr(urls, "MOST_BITS", most_bits)
    split = []
    keep = urls.members
    monkeypatch.setattr(urls, "members", lambda u, x, n: split.append(n) or keep(u, x, n))
    many = [f"http://h{i}.{'spam-farm' if i % 3 else 'fine'}.org/fr{i % 2 * '/'}x" for i in range(3000)]
    many += ["http://h1.spam-farm.org/a"] * 50
    all_ = URLS + many
    pages = spark.createDataFrame([(i, u, "k", "v") for i, u in enumerate(all_)] + [(None, URLS[0], None, None)],
                                  "page_id bigint, url string, key string, rule string")
    out = got(urls.judge(pages, URL_RULES, BLOCKED_LABELS))
    assert len(out) == len(all_) + 1 and (max(split, default=0) > 1) is (most_bits == 2048)
    for r in out:
        url = all_[r["page_id"] or 0]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected(url), url


def test_long_lists_are_judged_by_cascades(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BITS", 2048)
    built = []
    keep = urls.Cascade.contains
    monkeypatch.setattr(urls.Cascade, "contains", lambda self, key: built.append(len(self.levels)) or keep(self, key))
    universe = spark.range(9_000).selectExpr("concat('k', id) AS key")
    listed = universe.where("hash(key) % 6 = 0")
    c = urls.Cascade(universe, listed)
    found = urls.members(universe, listed, c.parts)
    assert c.parts > 1 and found.count() == listed.count() and found.subtract(listed).isEmpty()
    assert len(built) >= c.parts and max(built) > 1  # a cascade of several levels for each part


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id) AS key")
    listed = spark.range(20_000).where("id % 37 = 0").selectExpr("concat('k', id) AS key")
    c = urls.Cascade(universe, listed)
    assert len(c.levels) > 1
    assert universe.where(c.contains(universe["key"])).subtract(listed).isEmpty()
    assert universe.where(c.contains(universe["key"])).count() == listed.count()


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert urls.judge(pages.limit(0), URL_RULES, BLOCKED_LABELS).collect() == []
    assert got(urls.judge(pages, ()))[0]["verdict"] == "allow"
