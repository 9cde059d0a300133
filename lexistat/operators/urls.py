"""URL lists: rules, first matches, order-keeping distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexistat.functions.html import all_groups, rule_pattern
from lexistat.session import stage

RULE_GROUP = 200
GRAM = 4


def blocked(url: Column, rules: list[str]) -> Column:
    """True where any crawl rule is found anywhere in the URL.

    The rules of a site are few, so they become alternations tested in the scan; there is no join
    of URLs with rules.
    """
    patterns = [rule_pattern(rule.strip()) for rule in rules if rule.strip()]
    hit = F.lit(False)
    for i in range(0, len(patterns), RULE_GROUP):
        hit = hit | url.rlike("|".join(f"(?:{p})" for p in patterns[i : i + RULE_GROUP]))
    return hit


def allowed(urls: DataFrame, rules: list[str], url: str = "url") -> DataFrame:
    """Rows whose URL no rule blocks; a row without a URL is not blocked."""
    return urls.where(~F.coalesce(blocked(F.col(url), rules), F.lit(False)))


def site(url: Column) -> Column:
    """Scheme and host of a URL, the scope of a robots text."""
    return F.regexp_extract(url, "^(https?://[^/?#]+)", 1)


def rule_regex(rule: Column) -> Column:
    """The pattern of a rule in a column, as ``rule_pattern`` makes it of a string."""
    literal = F.regexp_replace(rule, r"([\\\[\](){}.+?^$|])", r"\\$1")
    return F.replace(literal, F.lit("*"), F.lit(".*"))


def _grams(text: Column) -> Column:
    """All distinct runs of GRAM characters."""
    return F.when(
        F.length(text) >= GRAM,
        F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(text, i, F.lit(GRAM)))
        ),
    ).otherwise(F.array().cast("array<string>"))


def _literal_grams(rule: Column) -> Column:
    """Grams that every URL blocked by a rule must hold: those between its wildcards."""
    return F.array_distinct(F.flatten(F.transform(F.split(rule, r"\*"), _grams)))


def rule_index(places: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(keys, apart)`` of distinct ``rules(site, rule)`` over ``places(site, url)``.

    ``keys(site, gram, pattern)`` has one row per rule: the literal gram of it that the fewest URLs of
    its site hold. A rule with a gram that no URL of its site holds blocks none and has no row. ``apart(site,
    pattern)`` has the rules without a literal of GRAM characters.
    """
    grams = rules.select("site", "rule", _literal_grams(F.col("rule")).alias("grams"))
    listed = stage(grams.select("site", "rule", F.explode("grams").alias("gram")), "rule-grams")
    wanted = listed.select("site", "gram").distinct()
    held = places.select("site", F.explode(_grams(F.col("url"))).alias("gram"))
    # Counted per task before anything moves; only grams of rules of the site are.
    counts = held.join(wanted, ["site", "gram"], "left_semi").groupBy("site", "gram").agg(F.count("*").alias("n"))
    rarest = (
        listed.join(counts, ["site", "gram"], "left")
        .groupBy("site", "rule")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("key"))
        .where("key.n > 0")
    )
    keys = rarest.select("site", "key.gram", rule_regex(F.col("rule")).alias("pattern"))
    apart = grams.where(F.size("grams") == 0).select("site", rule_regex(F.col("rule")).alias("pattern"))
    return stage(keys, "rule-keys"), stage(apart, "rules-apart")


def rule_candidates(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, pattern)``: the pairs that are tested, those of a URL with the rules whose key gram it holds."""
    keys, apart = rule_index(places, rules)
    held = places.select("site", "url", F.explode(_grams(F.col("url"))).alias("gram"))
    by_gram = held.join(keys, ["site", "gram"]).select("url", "pattern")
    return by_gram.unionByName(places.join(apart, "site").select("url", "pattern"))


def allowed_by_site(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose URL no rule of its own site blocks, for ``rules(site, rule)``.

    Rules are found by an equality join on the site and a run of characters, so a URL is tested by the
    few rules that may block it and not by all of its site. Rows without a URL are not blocked.
    """
    known = stage(
        rules.select("site", F.trim("rule").alias("rule")).where("rule != ''").distinct(), "rules"
    )
    places = urls.select(site(F.col(url)).alias("site"), F.col(url).alias("url")).where("url is not null").distinct()
    hits = rule_candidates(places, known).where(F.call_function("rlike", F.col("url"), F.col("pattern")))
    return urls.join(hits.select(F.col("url").alias(url)).distinct(), url, "left_anti").select(*urls.columns)


def extracted(pages: DataFrame, text: str, pattern: str, keys: list[str]) -> DataFrame:
    """``(keys, place, url)``: every match of a pattern, in text order."""
    return pages.select(
        *keys, F.posexplode(all_groups(F.col(text), pattern, 0)).alias("place", "url")
    )


def first_seen(urls: DataFrame, order: list[str], url: str = "url") -> DataFrame:
    """Each URL once, with the place where it was first seen."""
    first = urls.groupBy(url).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(url, *[F.col(f"_first.{name}").alias(name) for name in order])


def first_match(
    urls: DataFrame, path: str, suffix: str, order: list[str], url: str = "url"
) -> DataFrame:
    """The first URL that contains ``path`` and ends with ``suffix``; no row if there is none."""
    hits = urls.where(F.col(url).contains(path) & F.col(url).endswith(suffix))
    first = hits.agg(F.min(F.struct(*order, url)).alias("_first"))
    return first.where("_first is not null").select(
        *[F.col(f"_first.{name}").alias(name) for name in [*order, url]]
    )


def entries(urls: DataFrame, path: str, fragment: str = "", url: str = "url") -> DataFrame:
    """URLs with a path, followed by a fragment if one is given."""
    return urls.where(F.col(url).contains(f"{path}/{fragment}" if fragment else path))


def with_suffix(urls: DataFrame, suffix: str, rules: list[str], url: str = "url") -> DataFrame:
    """URLs with a suffix appended, as far as the rules allow."""
    return allowed(urls.withColumn(url, F.concat(url, F.lit(suffix))), rules, url)
