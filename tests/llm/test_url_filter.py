import math
from collections import Counter

from conftest import SMALL
from pyspark.sql import functions as F

from cashtide.llm import url_filter as uf


def brute(urls, order):
    """score of every address by the recursive definition."""
    counts = [Counter(), Counter()]
    for url, good, bad in urls:
        padded = uf.BEGIN * order + url + uf.END
        for i in range(order, len(padded)):
            for n in range(order + 1):
                for k, times in enumerate((good, bad)):
                    counts[k][padded[i - n : i + 1]] += times
    follows = [{}, {}]
    for k in (0, 1):
        for gram, n in counts[k].items():
            total = follows[k].setdefault(gram[:-1], [0, 0])
            total[0] += n
            total[1] += n > 0

    def chance(k, gram):
        shorter = chance(k, gram[1:]) if len(gram) > 1 else 1 / uf.ALPHABET
        seen, kinds = follows[k].get(gram[:-1], (0, 0))
        return (counts[k][gram] + kinds * shorter) / (seen + kinds) if seen else shorter

    out = {}
    for url, _, _ in urls:
        padded = uf.BEGIN * order + url + uf.END
        grams = [padded[i - order : i + 1] for i in range(order, len(padded))]
        out[url] = sum(math.log(chance(0, g)) - math.log(chance(1, g)) for g in grams) / len(grams)
    return out


def test_scores_equal_definition(spark):
    data = [("http://a.org/x", 1, 0), ("http://b.org/y?z", 1, 0), ("http://a.com/de/q", 0, 1), ("http://c.net/é", 0, 0), ("", 0, 0)]
    urls = spark.createDataFrame([(u, "allow" if g else "block" if b else None, True) for u, g, b in data], "url string, kind string, learns boolean")
    ratios = uf.log_ratios(uf.gram_counts(urls, 3), 3)
    wanted = brute(data, 3)
    found = {r.url: r.score for r in uf.scores(urls, ratios, 3).collect()}
    assert found.keys() == wanted.keys() and all(abs(found[u] - wanted[u]) < 1e-8 for u in wanted)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]


def rule(host, path):
    best = None
    for text, verdict in uf.RULES:
        site, _, rest = text.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + rest) and len(text) > len(best[0] if best else ""):
            best = text, verdict
    return best


def test_rules(spark):
    urls = [None, "", "no host", "http://", "HTTP://A.Example.ORG/en/1?x", "x://example.org/es/", "x://org/", "x://org", "x://aorg/", "x://b.com/fr/#", "x://com/de/a\nb", "a://b://c/d", "x://É.org/é?", "x://example.org/en/2"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in uf.judged(pages).collect():
        host, path = parts(urls[r.page_id])
        found = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, found and found[0])
        assert r.verdict == found[1] if found else r.verdict in ("allow", "block")
    assert uf.judged(pages.limit(0)).count() == 0


def test_no_join_is_broadcast(spark, monkeypatch):
    plans, store = [], uf.materialize

    def ran(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(uf, "materialize", lambda df, name: store(ran(df), name))
    urls = [f"http://a.{site}/{i}" for i in range(20) for site in ("com/fr", "com/de", "net/x")]
    pages = spark.createDataFrame(enumerate(urls), "page_id long, url string")
    assert len(ran(uf.judged(pages, order=2)).collect()) == len(urls)
    assert sum("SortMergeJoin" in p for p in plans) == 3 and not any("Broadcast" in p for p in plans)


def test_learned_verdicts_follow_the_language(spark):
    found = uf.judged(spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/pages.parquet")).where("rule is null")
    share = {r.lang: r.share for r in found.groupBy(F.substring("path", 1, 4).alias("lang")).agg(F.avg((F.col("verdict") == "block").cast("int")).alias("share")).collect()}
    assert share["/es/"] > 0.9 and share["/de/"] > 0.8 and share["/en/"] < 0.5 and share["/fr/"] < 0.5


