from __future__ import annotations

from tessera.llm import urls

URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "HTTP://A.Example.ORG/es/1?q#f", "https://example.org/en/148",
    "https://notexample.org/es/", "https://a.b.example.org/en/2", "http://x.com/fr", "http://x.com/fr/", "http://x.com/de/1",
    "http://com/de/", "http://x.com?/de/", "http://x.com#a/de/", "http://x.org:80/es/", "x://y://example.org/es/", "http://.org/",
    "http://ÉX.org/é", "http://a..org/es/", "http://example.org/es/" + "p" * 50000, "http://" + "a." * 5000 + "org/", "\nhttp://a.org/\nb",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
    fit = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


def test_as_by_brute_force(spark):
    rows = list(enumerate([*URLS, *URLS]))
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, host string")
    got = urls.verdicts(pages, urls.rule_table(spark)).collect()
    assert sorted(map(tuple, got)) == sorted((i, *brute(u)) for i, u in rows) or sorted(map(tuple, got), key=str) == sorted(
        ((i, *brute(u)) for i, u in rows), key=str
    )


def test_many_rules_of_many_lengths(spark):
    rules = [("block" if k % 3 else "allow", ".".join(["h"] * (k % 6) + [f"s{k % 40}", "org"]), "/" + "p" * (k % 170)) for k in range(900)]
    rows = [(k, f"http://www.{'h.' * (k % 7)}s{k % 45}.org/{'p' * (k * 7 % 190)}") for k in range(400)]
    got = urls.verdicts(spark.createDataFrame(rows, "page_id long, url string"), urls.rule_table(spark, rules)).collect()
    for r in got:
        fit = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        *_, verdict, rule = max(fit, default=(0, 0, "allow", None))
        assert (r.rule, r.verdict) == (rule, verdict)


def test_other_columns_keep_their_names(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "own")], "page_id long, url string, host string")
    out = urls.judge(pages, urls.rule_table(spark))
    assert out.columns == ["page_id", "url", "host", "_host", "path", "rule", "verdict"]
    assert tuple(out.first()) == (1, "http://a.org/x", "own", "a.org", "/x", "org/", "allow")


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    none = spark.createDataFrame([(None, "a.org", "/"), ("block", None, "/"), ("block", "", "/")], "verdict string, host string, path string")
    assert [r.verdict for r in urls.verdicts(pages, none).collect()] == ["allow"]
    assert urls.verdicts(pages.limit(0), urls.rule_table(spark)).count() == 0
