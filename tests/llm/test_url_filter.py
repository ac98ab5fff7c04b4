import random

from pyspark.sql import functions as F

from hiregrain.llm.url_filter import RULES, cascade, judged, member


def test_cascade_is_exact(spark):
    draw = random.Random(6)
    universe = spark.createDataFrame([(f"host{k}.example/{k % 7}",) for k in range(3000)], "key string")
    for size in (0, 1, 40, 1500, 3000):
        own = {f"host{k}.example/{k % 7}" for k in draw.sample(range(3000), size)}
        listed = spark.createDataFrame([(key,) for key in [*own, "elsewhere/"]], "key string")
        levels = cascade(listed, universe)
        found = universe.where(member(levels, F.col("key"))).collect()
        assert {row["key"] for row in found} == own
        assert "Join" not in universe.where(member(levels, F.col("key")))._jdf.queryExecution().toString()


def brute(url):
    rest = (url or "").partition("://")[2]
    host = rest
    for mark in "/?#":
        host = host.partition(mark)[0]
    path = rest[len(host) :]
    for mark in "?#":
        path = path.partition(mark)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_judges_as_the_rules_say(spark):
    draw = random.Random(9)
    hosts = ["com", "a.com", "Example.COM", "www.example.com", "x.www.example.com", "net", "b.net", "net.org", "xnet", "a..net", ".com", "É.com"]
    paths = ["", "/", "/en/", "/en", "/es/x", "/fr/", "/fr//?q", "?x=/es/", "#/fr/", "/EN/"]
    urls = [None, "", "no scheme", "://", "http://", "http://a://net/es/"]
    urls += [f"{draw.choice(['http', 'https', ''])}://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(400)]
    pages = spark.createDataFrame([(url, "x") for url in urls], "url string, rule string")
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    rows = judged(pages, rules).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == brute(row["row"]["url"])
    assert judged(pages.where(F.lit(False)), rules).count() == 0
    free = judged(pages, rules.where(F.lit(False))).collect()
    assert {(row["rule"], row["verdict"]) for row in free} == {(None, "allow")}
