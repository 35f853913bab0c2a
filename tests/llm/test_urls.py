import math
import re
from collections import Counter

from vigil.llm import urls

URLS = [(1, "http://A.com/x", "<p>cheap pills now</p>"), (2, "https://www.example.com/en/1", ""), (3, "https://example.com/en/1", None),
        (4, "https://b.example.com/en", "pills cheap"), (5, "http://q.net/es/3?x=/fr/", "cheap"), (6, "http://q.net/esx", ""), (7, None, "pills"),
        (8, "no scheme", ""), (9, "http://cheappills.org/en/5#t", ""), (None, "ftp://x.net?u=/es/", ""), (10, "http://com", ""),
        (11, "http://net/fr/9", ""), (11, "http://net/fr/9", ""), (12, "http://notnet/fr/9", "a b c"), (13, "http://cheap-pills.net/es/", "")]


def brute(rows):
    """(page_id, host, path, rule, verdict) by plain loops."""
    words = Counter()
    for _, _, html in rows:
        text = re.sub(r"<[^>]*>", " ", html or "").lower()
        words.update(w for w in re.split(r"[^a-z]+", text) if w and len(w) <= urls.MAX_WORD)
    total = sum(words.values()) or 1
    cost, unknown = {w: math.log(total / n) for w, n in words.items()}, math.log(total) - math.log(10)
    out, good, bad, share = [], Counter(), Counter(), [0, 0]
    tokens = lambda h, p: ([w for x in re.split(r"[^a-z]+", h) if x for w in urls.viterbi(x, cost, unknown)],
                           ["/" + x for x in re.split(r"[^a-z#]+", re.sub(r"[0-9]+", " #num ", p.lower())) if x])
    seen = []
    for key, url, _ in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(r), r, v) for v, r in urls.RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fit)[1] if fit else None
        verdict = max(fit)[2] if fit else None
        t = sum(tokens(host, path), [])
        seen += t
        if rule:
            (good if verdict == "allow" else bad).update(t)
            share[verdict == "block"] += 1
        out.append((key, host, path, rule, verdict, t))
    v, g, b = len(set(seen)), sum(good.values()), sum(bad.values())
    res = []
    for key, host, path, rule, verdict, t in out:
        odds = math.log((share[0] + 1) / (share[1] + 1)) + sum(math.log((good[x] + 1) / (g + v)) - math.log((bad[x] + 1) / (b + v)) for x in t)
        res.append((str(key), host, path, str(rule), verdict or ("allow" if round(odds, 9) >= 0 else "block"), round(odds, 6)))
    return sorted(res)


def rows(df):
    return sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict, round(r.log_odds, 6)) for r in df.collect())


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(*u, "keep") for u in URLS], "page_id long, url string, html string, host string")
    assert rows(urls.judge(df)) == brute(URLS)


def test_pages_table(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    got = urls.judge(df)
    assert rows(got) == brute([(r.page_id, r.url, r.html) for r in df.collect()])


def test_segmentation():
    cost = {"cheap": 1.0, "pills": 1.0, "a": 3.0}
    assert urls.viterbi("cheappills", cost, 5.0) == ["cheap", "pills"]
    assert urls.viterbi("", cost, 5.0) == []


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
