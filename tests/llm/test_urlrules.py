import random

import pytest

from logtables.llm import urlrules
from logtables.llm.queries import URL_RULES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return host.translate(LOW), rest[:end]


def judged(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, p, a) for a, h, p in rules if h is not None and p is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return (host, path, best[2] if best else None, best[4] if best else "allow")


URLS = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://a.b.example.org/es/x?y",
        "http://example.org/en/1#z", "http://example.org/en/2", "https://xexample.org/es/",
        "http://example.org-x/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://com/de/",
        "http://example.org./es/", "http://.org/", "http://x.org:80/es/", "http://example.org?/es/",
        "ftp://a://b/c", "HTTP://www.Example.ORG/es/é", "http://org/es/\nx", "://org/x",
        "http://a..org/x", "http://example.org/"]


@pytest.mark.parametrize("sweep", [3, 10_000])
def test_given_rules(spark, sweep):
    rows = [(i, u, "r", "k") for i, u in enumerate(URLS * 3)] + [(None, "http://org/", "r", "k")] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, key string")
    found = urlrules.judge_urls(pages, urlrules.rule_table(spark, URL_RULES), pages_per_sweep=sweep)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        ((i, *judged(u, URL_RULES)) for i, u, *_ in rows), key=repr)


def test_nested_rules_at_random(spark):
    rng = random.Random(3)
    hosts = [".".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)]
    paths = ["/", "/x", "/x/", "/x/y", "", "/y"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p)
                  for h in hosts for p in rng.sample(paths, 2)}.values()) + [("block", None, "/")]
    urls = [f"http://{rng.choice(['', 'c.', 'a.b.', 'ab'])}{rng.choice(hosts)}{rng.choice(paths)}"
            for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    table = spark.createDataFrame(rules, urlrules.RULES)
    found = urlrules.judge_urls(pages, table, pages_per_sweep=50)
    assert sorted(map(tuple, found.collect())) == sorted(
        (i, *judged(u, rules)) for i, u in enumerate(urls))


def test_many_path_rules_on_one_host(spark):
    """A hundred thousand nested paths, some given twice, and a host with most pages."""
    rng = random.Random(8)

    def path(n):
        return "".join(f"/{rng.randrange(12)}" for _ in range(n))

    rules = list({p: (rng.choice(["allow", "block"]), "x.org", p) for p in
                  (path(rng.randint(2, 7)) for _ in range(190_000))}.values())
    assert len(rules) > 100_000
    rules += [("block", "org", ""), ("allow", "x.org", "/1"), ("block", "x.org", "/1"),
              ("allow", "a.x.org", "/2/3")]
    by_path = {}
    for action, host, p in rules:
        by_path[host, p] = max(action, by_path.get((host, p), ""))
    urls = [f"http://{rng.choice(['x.org', 'x.org', 'a.x.org', 'b.a.x.org', 'y.org', 'com'])}{path(rng.randint(0, 9))}"
            for _ in range(3000)]
    table = spark.createDataFrame(rules, urlrules.RULES)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in urlrules.judge_urls(
        pages, table, pages_per_sweep=200).collect()}

    def best(url):
        host, p = parts(url)
        labels = host.split(".")
        fits = [(len(h + p[:n]), len(h), h + p[:n], by_path[h, p[:n]])
                for h in (".".join(labels[i:]) for i in range(len(labels)))
                for n in range(len(p) + 1) if (h, p[:n]) in by_path]
        return max(fits)[2:] if fits else (None, "allow")

    assert found == {i: best(u) for i, u in enumerate(urls)}


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://org/")], "page_id bigint, url string")
    rules = urlrules.rule_table(spark, URL_RULES)
    assert urlrules.judge_urls(pages.limit(0), rules).count() == 0
    none = urlrules.judge_urls(pages, rules.limit(0)).collect()
    assert [tuple(r) for r in none] == [(1, "org", "/", None, "allow")]


def test_only_spark_functions_run(spark):
    pages = spark.createDataFrame([(1, "http://org/")], "page_id bigint, url string")
    plan = urlrules.judge_urls(pages, urlrules.rule_table(spark, URL_RULES))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
