import random

from parcelpulse.llm import url_filter as uf
from parcelpulse.llm.queries import URL_RULES


def _rules(spark, rules=URL_RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def test_rules_like_brute_force(spark):
    random.seed(1)
    parts = ["http", "://", "www.", "EXAMPLE", "example", ".com", ".net", "/", "en/", "es/", "fr", "?", "#", "a", "É", ".", "www.example.com/en/"]
    urls = [None, "", "x", "://", "http://example.com", "http://example.com?/en/"]
    urls += ["".join(random.choice(parts) for _ in range(random.randint(1, 9))) for _ in range(300)]
    urls += ["http://" + "a." * 20_000 + "com/", "http://x.com/" + "p" * 100_000, urls[-1], urls[-1]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge_urls(pages, _rules(spark)).collect()}
    assert got == {i: _brute(u, URL_RULES) for i, u in enumerate(urls)}


def test_cascade_is_exact_within_its_universe(spark):
    listed = spark.range(0, 400).selectExpr("concat('k', id) AS key")
    universe = spark.range(0, 20_000).selectExpr("concat('k', id % 15000) AS key")
    uf._checkpoint_folder(spark)
    levels = uf.build_cascade(listed, universe, 15_000)
    assert len(levels) > 2
    hit = universe.distinct().where(uf.in_cascade(universe["key"], levels))
    assert {r.key for r in hit.collect()} == {f"k{i}" for i in range(400)}


def test_many_rules_and_odd_rules(spark):
    rules = [(f"h{i}.org", "/" + "p" * (i % 5), "block" if i % 2 else "allow") for i in range(200)]
    pages = [(i, f"http://s.h{i % 250}.org/{'p' * (i % 7)}") for i in range(500)]
    odd = [(None, "/", "block"), ("h1.org", None, "allow"), rules[3], ("h8.org", "/ppp", "block")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.judge_urls(df, _rules(spark, rules + odd)).collect()}
    assert got == {i: _brute(u, rules + [odd[3]])[2:] for i, u in pages}


def test_no_rules_no_rows_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", "mine")], "page_id long, url string, host string")
    out = uf.judge_urls(pages, _rules(spark).limit(0), otherwise="block").collect()
    assert [(r.host, r.rule, r.verdict) for r in out] == [("a.com", None, "block")]
    kept = uf.judge_urls(pages, _rules(spark), prefix="u_").first()
    assert kept.host == "mine" and kept.u_host == "a.com" and kept.u_verdict == "allow"
    assert uf.judge_urls(pages.limit(0), _rules(spark)).count() == 0
