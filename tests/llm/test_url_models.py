import math
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest

from docflow.llm import queries, urls

DATA = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end], rest[end:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(h + p, allow) for h, p, allow in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def test_query(spark):
    rows = queries.op9_urls(spark, DATA).collect()
    given = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert len(rows) == len(given)
    for r in rows:
        host, path = split(given[r.page_id])
        rule, allow = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == ("allow" if allow else "block")


HARD = [
    (1, "https://WWW.Example.ORG/es/1?x#y"), (2, "http://example.org/en/12"), (3, "http://myexample.org/en/1"), (4, "x.org/a"),
    (5, None), (6, ""), (7, "ftp://com/de/"), (8, "http://a.com/fr"), (9, "http://org?q=/a"), (10, "http://org/#://com/de/"),
    (None, "http://example.org"), (12, "://h.com/fr/é日"), (12, "://h.com/fr/é日"), (13, "http://u:p@h.org:80/" + "x" * 20_000),
]


def test_hard_cases(spark):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in HARD], "page_id long, url string, host string, score int")
    got = urls.judged(df).collect()
    assert len(got) == len(HARD)
    want = sorted((i or -1, *split(u), ruled(*split(u))[0]) for i, u in HARD)
    assert sorted(((r.page_id or -1, r.host, r.path, r.rule) for r in got), key=lambda x: x[:3]) == sorted(want, key=lambda x: x[:3])
    assert urls.judged(df.filter("page_id < 0")).count() == 0


def brute_log_p(texts, order):
    """Witten-Bell by counting contexts of each length."""
    symbol = lambda c: urls.ALPHABET.find(c) if c in urls.ALPHABET else urls.OTHER
    runs = Counter()
    for t in texts:
        codes = [urls.START] * order + [symbol(c) for c in t.lower()]
        for i in range(order, len(codes)):
            runs[tuple(codes[i - order : i + 1])] += 1

    def p(run):
        out = 1 / urls.SYMBOLS
        for k in range(order + 1):
            context = run[order - k : order]
            seen = Counter()
            for r, n in runs.items():
                if r[order - k : order] == context:
                    seen[r[order]] += n
            total, kinds = sum(seen.values()), len(seen)
            if total:
                out = (seen[run[order]] + kinds * out) / (total + kinds)
        return out

    return p


def test_probabilities():
    texts, order = ["a.org/ab", "ab.org/a1", "é.org"], 2
    counts = np.zeros(urls.SYMBOLS ** (order + 1), "i8")
    for t in texts:
        np.add.at(counts, urls.grams(t, order), 1)
    got, p = urls.log_probabilities(counts, order), brute_log_p(texts, order)
    for run in [*urls.grams("a.org/zb", order), *urls.grams("é9", order)]:
        a, rest = divmod(int(run), urls.SYMBOLS**2)
        b, c = divmod(rest, urls.SYMBOLS)
        assert got[run] == pytest.approx(math.log(p((a, b, c))))
    assert np.exp(got).reshape(-1, urls.SYMBOLS).sum(1) == pytest.approx(1)


def test_scores_tell_paths_apart(spark):
    words = ["news", "story", "blog", "paper"], ["casino", "poker", "viagra", "slots"]
    rows = [(i, f"http://h{i}.org/es/{quote(words[0][i % 4])}/{i}") for i in range(200)]
    rows = [(i, u.replace("/es/", "/")) for i, u in rows]
    rows += [(1000 + i, f"http://h{i}.com/de/{words[1][i % 4]}/{i}") for i in range(200)]
    rows += [(2000, "http://x.net/de/casino/9"), (2001, "http://x.net/news/story/9")]
    got = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[2000] == "block" and got[2001] == "allow"
