import pytest

from lakesmith.llm import url_filter as u
from lakesmith.llm.queries import URL_RULES

CASES = [
    ("https://www.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://a.example.com/EN/", "a.example.com", "/EN/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("x://h.net/es/1/es/", "h.net", "/es/1/es/", "net/es/", "block"),
    ("x://h.net?/es/", "h.net", "", None, "allow"),
    ("http://casino-win.example.org/en/", "casino-win.example.org", "/en/", None, "block"),
    ("http://casinowin.example.org/a", "casinowin.example.org", "/a", None, "allow"),
    ("http://ok.org/x://casino.com/", "ok.org", "/x://casino.com/", None, "allow"),
    ("http://ok.org/a/Adult/b", "ok.org", "/a/Adult/b", None, "allow"),
    ("http://ok.org/a/adult?x", "ok.org", "/a/adult", None, "allow"),
    ("http://ok.org/a/adult", "ok.org", "/a/adult", None, "block"),
    ("no scheme/casino", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://KöLN.com/\n/x", "köln.com".replace("ö", "ö"), "/\n/x", "com/", "allow"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, c[0], "h", "v") for i, c in enumerate(CASES)],
                                 "page_id long, url string, host string, VERDICT string")


def test_verdicts(pages):
    out = u.filter_urls(pages, URL_RULES)
    assert [c.lower() for c in out.columns].count("verdict") == 1
    for r in out.collect():
        assert (r["url"], r["host"], r["path"], r["rule"], r["verdict"]) == CASES[r["page_id"]]


def test_blocks_of_rules_give_the_same(pages, monkeypatch):
    want = sorted(map(repr, u.filter_urls(pages, URL_RULES).collect()))
    monkeypatch.setattr(u, "BLOCK_RULES", 2)
    assert sorted(map(repr, u.filter_urls(pages, URL_RULES).collect())) == want


def test_rules_are_filed_under_their_rarest_token():
    rules = [u.host_path_rule("www.example.com/en/", "allow"), u.pattern_rule("p", "block", "x")]
    assert u.file_rules(rules, {"www": 9, "example": 50, "com": 20, "en": 3}) == {"en": [0], "": [1]}
    # a token that the prefix cuts off is no whole token
    assert u.host_path_rule("a.com/pre", "block").literals == ("a", "com")


def test_empty_and_no_rules(spark, pages):
    none = spark.createDataFrame([], "page_id long, url string")
    assert u.filter_urls(none, URL_RULES).count() == 0
    assert {r["verdict"] for r in u.filter_urls(pages, [], default="block").collect()} == {"block"}


LIST = ["! a comment", "[Adblock Plus 2.0]", "", "||ads.example.com^", "||tracker.net^*/pixel", "@@||ads.example.com/fine/", "/banner/*/ad.", "|http://start.org/x",
        "swf|", "/^shop[0-9]+\\.example/", "||opt.com^$third-party", "site.com##.ad", "||UPPER.com^"]
VERDICTS = [
    ("https://ads.example.com/x", "||ads.example.com^"), ("https://a.ads.example.com", "||ads.example.com^"),
    ("https://ads.example.com/fine/x", "@@||ads.example.com/fine/"), ("https://bads.example.com/x", None),
    ("http://ads.example.com.org/", None), ("http://tracker.net/a/b/pixel?x", "||tracker.net^*/pixel"), ("http://tracker.net/pixel", None),
    ("http://x.org/banner/1/ad.gif", "/banner/*/ad."), ("http://start.org/xyz", "|http://start.org/x"), ("http://a.start.org/x", None),
    ("http://x.org/movie.swf", "swf|"), ("http://x.org/movie.swf?x", None), ("http://shop12.example/q", "/^shop[0-9]+\\.example/"),
    ("http://opt.com/", None), ("http://site.com/", None), ("http://upper.com/", "||UPPER.com^")]


def test_rule_lists(spark):
    rules = u.parse_rules(LIST)
    assert [r.name for r in rules] == [*LIST[3:10], LIST[12]]
    pages = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(VERDICTS)], "page_id long, url string")
    for r in u.filter_urls(pages, rules).collect():
        want = VERDICTS[r["page_id"]][1]
        assert (r["pattern"], r["verdict"]) == (want, "block" if want and not want.startswith("@@") else "allow"), r["url"]


def test_thousands_of_rules_equal_trying_each(spark, monkeypatch):
    import random
    import re
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["ads", "Shop", "img"]
    lines = []
    for _ in range(3000):
        host = ".".join(rng.choices(words, k=rng.randint(1, 3))) + ".com"
        lines.append(rng.choice([f"||{host}^", f"||{host}/{rng.choice(words)}", f"/{rng.choice(words)}/*{rng.choice(words)}/", f"@@||{host}^",
                                 f"|http://{host}/{rng.choice(words)}^", f"{rng.choice(words)}.{rng.choice(words)}.com/x|"]))
    rules = u.parse_rules(lines)
    urls = ["http://" + ".".join(rng.choices(words, k=rng.randint(1, 3))) + ".com" + "".join(f"/{w}" for w in rng.choices([*words, "x"], k=rng.randint(0, 4)))
            for _ in range(120)]
    want = {}
    for url in urls:
        rest = url.partition("://")[2]
        host, slash, path = rest.partition("/")
        target = host.lower() + slash + path
        fits = [(-r.kind, len(r.name), -i, r.name, r.verdict) for i, r in enumerate(rules) if re.search(r.regex, target, re.DOTALL)]
        want[url] = max(fits)[3:] if fits else (None, "allow")
    assert len({v for v in want.values()}) > 20
    monkeypatch.setattr(u, "BLOCK_RULES", 1100)
    pages = spark.createDataFrame([(url,) for url in urls], "url string")
    assert {r["url"]: (r["pattern"], r["verdict"]) for r in u.filter_urls(pages, rules).collect()} == want
