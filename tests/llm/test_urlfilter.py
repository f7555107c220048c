import re

from tessera.llm import urlfilter
from tessera.llm.queries import URL_RULES

URLS = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "https://x.www.example.com/en/1", "http://example.com/EN/",
        "http://notexample.com/en/", "http://shop.net/es/a", "http://net/es/", "http://shop.net/fr", "ftp://a.org#x", "http://a.com?x=/en/",
        "http://com/", "nothing", "", None, "http://", "://q/w", "http://a.com/b://c", "x" * 50_000 + "://h/p", "http://É.com/Ä\nb?c"]


def brute(url):
    """(host, path, rule, verdict or null) of the stated rules."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fit)[1], max(fit)[2]) if fit else (None, None)))


def test_rules_and_model(spark):
    rows = [(k, u, "x") for k, u in enumerate(URLS)]
    rows += [(100 + k, f"http://good{k}.org/news/{k}", "x") for k in range(60)] + [(200 + k, f"http://bad{k}.org/casino/{k}", "x") for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    parsed = urlfilter.parsed(pages, URL_RULES)
    label = urlfilter.parsed(pages.where("page_id >= 100 AND page_id % 2 = 0"), ()).selectExpr("host", "path", "path LIKE '/casino%' AS blocked")
    out = {r.page_id: r for r in urlfilter.judge(parsed, urlfilter.train(label)).collect()}
    for k, u, _ in rows:
        host, path, rule, verdict = brute(u)
        assert (out[k].host, out[k].path, out[k].rule) == (host, path, rule), u
        if verdict:
            assert out[k].verdict == verdict
    unseen = [out[k] for k in range(100, 260) if k in out and k % 2]
    assert all(r.verdict == ("block" if "/casino" in r.path else "allow") for r in unseen)


def test_no_labels_allow_and_empty_table(spark):
    none = spark.createDataFrame([], "host string, path string, blocked boolean")
    weights = urlfilter.train(none)
    pages = spark.createDataFrame([(1, "http://a.org/"), (None, None), (1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in urlfilter.judge(urlfilter.parsed(pages, URL_RULES), weights).collect()] == ["allow"] * 3
    assert urlfilter.judge(urlfilter.parsed(pages.limit(0), URL_RULES), weights).collect() == []
