from math import sqrt

from tidemark.llm.url_filter import RULES, url_filter

SCHEMA = "page_id long, url string, html string, n string, good string, host string"


def _pages():
    rows, i = [], 0
    for host, n in (("good.a.com", 60), ("bad.a.com", 60), ("few.a.com", 3), ("x.b.org", 40), ("y.b.org:8080", 40), ("new.c.io", 2)):
        for k in range(n):
            i += 1
            rows.append((i, f"https://{host.upper() if k % 2 else host}/p/{k}?q#f"))
    odd = [None, "", "no scheme", "://", "http://", "http://a.net", "http://a.net/", "http://x.example.net/en/1", "http://example.com/de/",
           "http://notexample.com/de/", "http://o.org/fr/", "http://o.org/f", "http://h?x/y", "http://h#a://b/c", "http://É.net/É/ü", "http://net/x"]
    return rows + [(1000 + i, u) for i, u in enumerate(odd)] + [(1005, "http://a.net"), (None, "http://a.com/z")]


def _plain(url):
    text = url or ""
    if "://" not in text:
        return "", ""
    rest = text.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def _rule(host, path):
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_parts_rules_and_reputation(spark):
    pages = _pages()
    labels = [(p, 0 if "bad" in u.lower() else 1, 0) for p, u in pages[:200] if p]
    rows = spark.createDataFrame([(*p, "h", "n", "g", "x") for p in pages], SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {(r.page_id, r.host, r.path): r for r in url_filter(rows, marks).collect()}
    assert url_filter(rows, marks).count() == len(pages)
    for page, url in pages:
        host, path = _plain(url)
        r = got[page, host, path]
        rule, verdict = _rule(host, path)
        assert r.rule == rule and r.verdict == (verdict or ("block" if r.good_upper < 0.5 else "allow"))
    verdicts = {r.host: r.verdict for r in got.values() if r.rule is None}
    assert verdicts["bad.a.com"] == "block"
    assert all(verdicts[h] == "allow" for h in ("good.a.com", "few.a.com", "x.b.org", "y.b.org:8080", "new.c.io", ""))
    bound = next(r for r in got.values() if r.host == "bad.a.com")
    assert bound.good_mean < bound.good_upper < bound.good_mean + 2 * sqrt(bound.good_mean * (1 - bound.good_mean) / 60)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert url_filter(spark.createDataFrame([], SCHEMA), none).collect() == []
    some = url_filter(spark.createDataFrame([(1, "http://a.com/", "h", "n", "g", "x")], SCHEMA), none).collect()
    assert [(r.verdict, r.good_mean) for r in some] == [("allow", 0.5)]
