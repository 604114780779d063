import random
from urllib.robotparser import RobotFileParser

from webcorpus.config import CrawlConfig
from webcorpus.functions.urls import host_key
from webcorpus.operators import policy as P
from webcorpus.sources.robots import robots_rules
from webcorpus.sources.seeds import allow_domains, seeds_from, spec_table

SAMPLE_SKIP = r"[.]css(\?|$);[.]tar[.]gz$"

BODIES = {
    "https://a": "User-agent: *\nDisallow: /x\nAllow: /x/y\n",
    "https://b": "User-agent: mozilla\nUser-agent: z\nAllow: /x/y\nDisallow: /x\n\nUser-agent: *\nDisallow: /\n",
    "https://c": "User-agent: *\n\nDisallow: /x\n",
    "https://d": "Disallow: /x\nUser-agent: other\nDisallow: /\n",
    "https://e": "User-agent: *\nDisallow:\n# note\n\nUser-agent: *\nDisallow: /\n",
    "https://f": "User-agent: Moz\nCrawl-delay: 3\nUser-agent: *\nDisallow: /\n",
    "https://g": "user-agent : *\r\ndisallow : /%78 # c\r\nfoo: bar\r\nallow:*\r\n",
    "https://h": "User-agent: *\nDisallow: *\n",
    "https://i": "User-agent: *\nfoo: x\nUser-agent: q\nDisallow: /x\nDisallow: /z\nUser-agent: *\nDisallow: /y",
}
PATHS = ["", "/", "/x", "/x/y", "/x/y/z", "/y", "/%78/q", "/z+1"]


def test_robots_equal_standard_library(spark):
    robots = spark.createDataFrame(
        [(b, 200, body) for b, body in BODIES.items()]
        + [("https://s401", 401, None), ("https://s404", 404, None), ("https://s500", 500, None), ("https://down", None, None)],
        "base string, status int, body string",
    )
    agent = CrawlConfig().user_agent
    policies = P.robots_policies(robots, robots_rules(robots), agent)
    hosts = [*BODIES, "https://s401", "https://s404", "https://s500", "https://down", "https://none"]
    urls = spark.createDataFrame([(h + p,) for h in hosts for p in PATHS], "url string")
    got = {r.url: r.allowed for r in P.robots_allowed(urls, "url", policies).collect()}
    for base, body in BODIES.items():
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        parser.modified()
        for path in PATHS:
            assert got[base + path] == parser.can_fetch(agent, base + path), (base, path)
    for path in PATHS:
        assert not got["https://s401" + path] and not got["https://s500" + path]
        assert got["https://s404" + path] and got["https://down" + path] and got["https://none" + path]


def test_one_robots_file_for_a_base(spark):
    old, new = "User-agent: *\nDisallow: /old\n", "User-agent: *\nDisallow: /new\n"
    robots = spark.createDataFrame(
        [("https://a", 200, old, 1), ("https://a", 200, new, 2), ("https://a", None, None, 0)],
        "base string, status int, body string, fetched_at int",
    )
    policies = P.robots_policies(robots, robots_rules(robots))
    urls = spark.createDataFrame([("https://a/old",), ("https://a/new",)], "url string")
    got = sorted((r.url, r.allowed) for r in P.robots_allowed(urls, "url", policies).collect())
    assert got == [("https://a/new", False), ("https://a/old", True)]
    # Without a time the choice is still one file.
    assert P.robots_policies(robots.drop("fetched_at"), robots_rules(robots.drop("fetched_at"))).count() == 1


def test_skip_and_route(spark):
    config = CrawlConfig(skip_regexes=SAMPLE_SKIP)
    cases = {
        "https://x/a.css?v=1": True,
        "https://x/a.JS": False,
        "https://x/a.tar.gz": True,
        "ftp://x/a": True,
        "mailto:a@b": True,
        "HTTP://x/a": False,
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = df.select("url", P.should_skip("url", config.skip_patterns).alias("s")).collect()
    assert {r.url: r.s for r in got} == cases
    kinds = {"a.PDF": "pdf", "a.docx": "docx", "a.xlsx": "xlsx", "a.doc": "unsupported", "a.xls": "unsupported", "a": "html"}
    df = spark.createDataFrame([(u,) for u in kinds], "url string")
    assert {r.url: r.k for r in df.select("url", P.route("url").alias("k")).collect()} == kinds
    assert df.filter("url = 'a.PDF'").select(P.route("url", ("docx",))).first()[0] == "html"


def test_python_patterns_become_java(spark):
    assert P.java_pattern(r"(?P<n>a)(?P=n)\Z") == r"(?<n>a)\k<n>\z"
    df = spark.createDataFrame([("https://x/aa",)], "url string")
    assert df.select(P.should_skip("url", [r"(?P<n>a)(?P=n)\Z"])).first()[0]


def test_allow_domains(spark):
    urls = ["https://example.com/a", "https://www.sub.example.com", "https://badexample.com", "https://other.org"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    table = spark.createDataFrame([("example.com",)], "domain string")
    for domains in (table, ["example.com"]):
        got = sorted(r.url for r in P.allow_domain_semi(df, "url", domains).collect())
        assert got == urls[:2]
    assert P.allow_domain_semi(df, "url", []).count() == 0


def test_seed_and_domain_lists(spark):
    seeds = seeds_from(spec_table(spark, " https://WWW.a.com/x ;; https://b.org ;"))
    assert [r.seed for r in seeds.collect()] == ["https://WWW.a.com/x", "https://b.org"]
    listed = spec_table(spark, "www.C.com; d.net ;")
    loose = {r.domain for r in allow_domains(listed, seeds).collect()}
    strict = {r.domain for r in allow_domains(listed, seeds, strict=True).collect()}
    assert loose == {"a.com", "b.org", "c.com", "d.net"}
    assert strict == {"a.com", "b.org", "www.c.com", "d.net"}
    assert seeds.select(host_key("seed")).first()[0] == "a.com"


def test_settings():
    config = CrawlConfig.from_env({"MAX_DEPTH": "5", "SAVE_404": "TRUE", "INCLUDE_PDFS": "no", "SKIP_REGEXES": "a; b;;"})
    assert (config.max_depth, config.save_404, config.include_pdfs) == (5, True, False)
    assert config.skip_patterns == ["a", " b"] and config.routes == ("docx", "xlsx")
    assert config.window_size == 8091 and config.token_overlap == 300


def test_the_index_of_rules_decides_as_the_array_does(spark):
    """A site of 10,000 rules, nested and repeated prefixes, an empty one at last."""
    rng = random.Random(4)
    words = ["a", "b", "ab", "abc", "x/", "y"]
    prefixes = ["/" + "".join(rng.choices(words, k=rng.randrange(1, 7))) for _ in range(9_999)] + [""]
    rules = [(k, rng.random() < 0.5, p) for k, p in enumerate(prefixes)]
    few = [(0, True, "/a"), (1, False, "/")]
    policies = spark.createDataFrame(
        [("https://big", False, rules), ("https://few", False, few), ("https://shut", True, rules), ("https://open", False, None)],
        "base string, deny_all boolean, rules array<struct<rule_no:int,allow:boolean,prefix:string>>",
    )
    paths = ["/" + "".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(200)] + ["", "/q%61", "/zzz"]
    urls = [(f"https://{site}{path}",) for site in ("big", "few", "shut", "open", "none") for path in paths]
    df = spark.createDataFrame(urls + urls[:5], "url string")
    by_index = P.robots_allowed(df, "url", policies).orderBy("url").collect()
    by_array = P.robots_allowed(df, "url", policies, many=10**6).orderBy("url").collect()
    assert by_index == by_array and len(by_index) == len(urls) + 5
    assert len({r.allowed for r in by_index if "//big" in r.url}) == 2
    index = P.rule_index(policies)
    assert index.count() <= len(set(prefixes)) * 2
