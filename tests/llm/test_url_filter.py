import random

from snaplake.llm import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    for mark in "?#":
        rest = rest.split(mark)[0]
    host, slash, path = rest.partition("/")
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, slash + path


def verdict(url, rules, default="allow"):
    host, path = parse(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else default)


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    book = spark.createDataFrame(rules, "host string, path string, action string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict)
            for r in url_filter.judge(pages, book).collect()}


def test_against_every_rule(spark):
    rng = random.Random(4)
    hosts = ["a.example.org", "EXAMPLE.org", "example.org", "org", "xorg", "b.c.com", "com",
             "sex.example.org.com", "a..org", "", "É.com", "u:p@x.org:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/fr/", "/fr/#://x", "/de/x", "/de", "/EN/1",
             "?q", "#top", "//es/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://", "mailto:x@org", "x://org/://com/de/", "a" * 5000]
    got = judged(spark, urls, RULES)
    assert got == {i: verdict(u, RULES) for i, u in enumerate(urls)}


def test_precedence_ties_and_odd_rules(spark):
    rules = [("a.org", "/", "allow"), ("org", "/ab", "block"), ("a.org", "/x", "block"),
             ("a.org", "/x", "allow"), ("a.org", "/x", "allow"), (None, "/", "block"),
             ("a.org", None, "block")]
    urls = ["http://a.org/ab", "http://a.org/x", "http://a.org/", "http://b.org/ab"]
    got = judged(spark, urls, rules)
    clean = [r for r in rules if None not in r]
    assert got == {i: verdict(u, clean) for i, u in enumerate(urls)}
    assert got[1][3] == "block"


def test_no_rules_no_pages_repeated_pages(spark):
    assert judged(spark, ["http://a.org/"], [])[0] == ("a.org", "/", None, "allow")
    assert judged(spark, [], RULES) == {}
    pages = spark.createDataFrame([(1, "http://a.org/", "x")] * 3, "page_id long, url string, rule string")
    book = spark.createDataFrame(RULES, "host string, path string, action string")
    assert url_filter.judge(pages, book).count() == 3
