import random

import pytest

from indicata.llm import url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("a.b.net", "/es/x", "allow"), ("b.net", "/", "block"), ("example.com", "/en/", "allow"), ("EXAMPLE.org", "", "block")]


def brute(url, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3:]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h.lower() + p), len(h), v == "block", h.lower() + p, v) for h, p, v in RULES
            if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def urls():
    rng = random.Random(1)
    hosts = ["com", "example.com", "www.example.com", "WWW.Example.COM", "x.www.example.com", "xexample.com", "net", "b.net", "a.b.net",
             "z.a.b.net", "ab.net", "example.org", "", "com.", ".com", "u@b.net:80", "été.net", "com-x.com", "\u00e9.com"]
    paths = ["", "/", "/en/", "/en", "/en/x?q=/es/", "/es/", "/es/x/y#z", "/fr/", "?a", "#b", "//", "/ES/"]
    out = [f"{rng.choice(['http', 'https', 'x'])}://{h}{p}" for h in hosts for p in paths]
    return out + [None, "", "no scheme", "a:/b", "http://http://net/es/", "http://" + "a." * 3000 + "net/es/" + "p" * 50_000] + ["http://b.net/hot"] * 300


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_equals_brute_force(spark, ranges):
    rows = list(enumerate(urls())) + [(None, "http://net/es/")]
    frame = spark.createDataFrame([(i, u, "k", 1) for i, u in rows], "page_id long, url string, key string, part int")
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("com", None, "block"), ("com", "/", None)],
                                  "host string, path string, verdict string")
    got = url_filter.match_urls(frame.repartition(3), rules, ranges=ranges).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(i, *brute(u)) for i, u in rows], key=str)


def test_empty_sides(spark):
    frame = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.match_urls(frame.limit(0), rules).count() == 0
    assert [tuple(r) for r in url_filter.match_urls(frame, rules.limit(0), default="block").collect()] == [
        (1, "a.com", "/x", None, "block")]


def test_many_rules_at_range_ends(spark):
    rules = [(f"d{k}.com", "/", "block" if k % 2 else "allow") for k in range(200)] + [(f"s.d{k}.com", "/p", "allow") for k in range(200)]
    rows = [(k * 10 + j, f"http://{h}d{k % 210}.com/{p}") for k in range(210) for j, (h, p) in enumerate([("", ""), ("s.", "p"), ("t.s.", "p"), ("s.", "q")])]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.match_urls(
        frame, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=17).collect()}
    for i, u in rows:
        k, j = divmod(i, 10)
        if k >= 200:
            assert got[i] == (None, "allow")
        elif j in (1, 2):
            assert got[i] == (f"s.d{k}.com/p", "allow")
        else:
            assert got[i] == (f"d{k}.com/", "block" if k % 2 else "allow")


class Counted(str):
    """A text that counts how often it is compared."""
    seen = 0

    def __lt__(self, other):
        Counted.seen += 1
        return str.__lt__(self, other)


def test_work_per_url_is_logarithmic_in_the_rules_of_its_host():
    rng = random.Random(3)
    nested = ["/" + "n" * k for k in range(300)]
    paths = sorted({f"/{k:05d}/" for k in range(100_000)} | set(nested) | {"", "/", "/\U0010ffff", "/\U0010ffff\U0010ffffx"})
    own = url_filter.HostRules("com.hot.")
    for path in paths:
        own.add("hot.com", path, "block")
    have = set(paths)
    asked = [f"/{rng.randrange(100_100):05d}/x" for _ in range(300)] + [p + "x" for p in nested] + ["", "x", "/\U0010ffff\U0010ffffxy", "/\U0010ffffa"]
    for path in asked:
        want = next(path[:k] for k in range(len(path), -1, -1) if path[:k] in have)
        Counted.seen = 0
        assert own.best(Counted(path))[3] == "hot.com" + want
        assert Counted.seen <= 19
    assert len(own.starts) <= 2 * len(paths) + 1


@pytest.mark.parametrize("ranges", [2, 25])
def test_many_rules_of_a_hot_host(spark, ranges):
    rng = random.Random(4)
    words = ["a", "b", "c", "ab", "\u00e9", "\U0010ffff", "z/"]
    text = lambda most: "/" + "".join(rng.choice(words) for _ in range(rng.randrange(most)))
    rules = {(h, text(6), rng.choice(["allow", "block"])) for h in ("com", "hot.com", "x.hot.com", "y.net") for _ in range(1500)}
    rows = [(i if i % 3 else None, f"http://{h}{text(9)}") for i in range(2000) for h in [rng.choice(["hot.com", "hot.com", "x.hot.com", "z.y.net", "com"])]]
    rows += [(None, "http://hot.com/ab")] * 1000
    by_host = {}
    for h, p, v in rules:
        key = by_host.setdefault(h, {})
        key[p] = max(key.get(p, (False, "")), (v == "block", v))

    def want(url):
        host, path = url[7:].split("/", 1)
        path, labels = "/" + path, host.split(".")
        fits = [(len(h) + k, len(h), *own[path[:k]][:1], h + path[:k], own[path[:k]][1]) for h, own in by_host.items()
                if labels[-len(h.split(".")):] == h.split(".") for k in range(len(path) + 1) if path[:k] in own]
        best = max(fits, default=None)
        return best and best[3], best[4] if best else "allow"

    frame = spark.createDataFrame(rows, "page_id long, url string").repartition(5)
    table = spark.createDataFrame(list(rules) + list(rules)[:50], "host string, path string, verdict string")
    got = sorted(((r.page_id, f"http://{r.host}{r.path}", r.rule, r.verdict)
                  for r in url_filter.match_urls(frame, table, ranges=ranges).collect()), key=str)
    assert got == sorted(((i, u, *want(u)) for i, u in rows), key=str)


def test_rules_reach_all_ranges_they_can_fit_and_no_others():
    rng = random.Random(5)
    keys = ["com.", "com.a.", "com.a.b.", "com.aa.", "net."]
    texts = ["", "/", "/a", "/a/", "/ab", "/b", "/b/c"]
    for _ in range(200):
        bounds = sorted({(rng.choice(keys), rng.choice(texts), rng.randrange(3)) for _ in range(rng.randrange(9))})
        parts = url_filter.rule_parts(bounds)
        for key in keys:
            for path in texts:
                placed = parts(key, path)
                assert len(placed) == len(set(placed))
                for k in keys:
                    for p in [*texts, "/a/x", "/zz"]:
                        if k.startswith(key) and p.startswith(path):
                            for salt in range(-1, 4):
                                assert url_filter.bisect_right(bounds, (k, p, salt)) in placed
    hot = [("com.hot.", f"/{k:03d}", 0) for k in range(500)]
    assert len(url_filter.rule_parts(hot)("com.hot.", "/100/x")) <= 4
