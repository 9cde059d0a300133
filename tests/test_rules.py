"""Crawl rules found by their grams, against every rule tried on every URL."""

import random
import re

from pyspark.sql import functions as F

from lexistat.operators import urls


def brute(places, rules):
    kept = []
    for number, url in places:
        site = re.match(r"https?://[^/?#]+", url or "")
        own = [r.strip() for s, r in rules if site and s == site[0] and r and r.strip()]
        if not any(re.search(".*".join(map(re.escape, rule.split("*"))), url) for rule in own):
            kept.append(number)
    return kept


def test_random_rules_and_urls(spark):
    chance = random.Random(3)
    letters = "ab/?*.=x+(E"
    sites = ["http://a.example", "https://b.example"]

    def text(most):
        return "".join(chance.choice(letters) for _ in range(chance.randrange(most)))

    places = [(i, f"{chance.choice(sites)}/{text(12).replace('*', '1')}") for i in range(300)]
    places += [(1000, None), (1001, "no url"), (1002, "http://a.example"), (1003, places[0][1])]
    rules = [(chance.choice(sites), text(9)) for _ in range(60)]
    rules = [(s, r) for s, r in rules if set(r) - set("* ") and len(r) > 2]
    rules += [("http://a.example", "  "), ("http://a.example", ""), ("http://a.example", None), (None, "/ab")]
    rules += [("https://b.example", "a\\E.x"), ("https://b.example", "https://b*ab*ba")]
    found = urls.allowed_by_site(
        spark.createDataFrame(places, "id int, url string"), spark.createDataFrame(rules, "site string, rule string")
    )
    assert found.columns == ["id", "url"]
    assert sorted(r["id"] for r in found.collect()) == brute(places, rules)


def test_rules_with_and_without_a_long_literal(spark):
    cases = {"*": True, "/a": True, "b*c": False, "example/a*z": True, "zzzz": False}
    places = spark.createDataFrame([(f"http://s{i}.example/a/xyz",) for i in range(len(cases))], "url string")
    rules = spark.createDataFrame([(f"http://s{i}.example", rule) for i, rule in enumerate(cases)], "site string, rule string")
    kept = {r["url"] for r in urls.allowed_by_site(places, rules).collect()}
    assert kept == {f"http://s{i}.example/a/xyz" for i, blocked in enumerate(cases.values()) if not blocked}


def test_pairs_grow_with_the_pages_of_a_site(spark):
    """Every page brings a rule of its own and shares one with all: a pair of its own each, and those that match."""
    names = F.concat(F.lit("http://"), F.char(F.lit(97) + F.col("id") % 2), F.lit(".example"))
    places = spark.range(400).select(names.alias("site"), "id").select(
        "site", F.concat("site", F.lit("/page/"), F.format_string("%05d", "id"), F.lit("/text")).alias("url")
    )
    own = places.select("site", F.substring("url", 17, 12).alias("rule"))
    rules = own.union(own.select("site", F.lit("/*?*page="))).distinct()
    pairs = urls.rule_candidates(places, rules)
    assert pairs.count() <= 2 * 400
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
