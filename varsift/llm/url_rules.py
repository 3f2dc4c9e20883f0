"""URL filtering: fixed host and path rules, then association rules mined from labels.

A page's url is a set of tokens: every host label with its place from the right, the first path segment, every
further one wherever it stands, the extension and every query key.
Spark's FP-growth mines the token combinations of the labelled pages; a combination becomes a block rule if at least
``LEAST_PAGES`` labelled pages hold it (support) and of these surely enough are bad: the lower end of the 95 % Wilson
interval of its confidence counts, so a few pages never make a rule. Tokens found on exactly the same labelled pages are
one item (its first name), so a url with very many parts does not multiply the combinations. A rule with a more general
rule of at least its confidence is dropped. Rules match through an inverted index: a rule is filed under its rarest
token, urls are joined on their tokens (those that some rule holds), and only there the rest of the rule is compared.

DataFrame and SQL functions only. The mining sees labelled pages; FP-growth's driver part and the matching hold the
tokens of at least ``LEAST_PAGES`` labelled pages. Distinct sets of rule tokens are matched once, whatever the number of their urls.

Defined cases: a null url or one without ``://`` has an empty host and path, no tokens and is allowed; repeated rows give
repeated results; without labels no rule is mined and only fixed rules block.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varsift.llm.storage import written

#: Fixed rules (host and path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
#: A rule rests on this many labelled pages at least, and its confidence's lower bound (normal deviate Z) is this.
LEAST_PAGES, CONFIDENCE, Z = 20, 0.8, 1.96
BAD = "label:bad"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    def part(k: int) -> Column:
        return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))

    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def fixed_rule(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict (null without one)."""
    rule, verdict = [], []
    for text, decision in sorted(rules, key=lambda r: -len(r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit("/" + path))
        rule.append(F.when(fits, F.lit(text)))
        verdict.append(F.when(fits, F.lit(decision)))
    return F.coalesce(*rule), F.coalesce(*verdict)


def url_tokens(url: str = "url") -> Column:
    """The sorted distinct tokens of ``host``, ``path`` and the query, however many."""
    labels = F.split("host", r"\.")
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"\?([^#]*)", 1)
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    named = F.transform(segments, lambda x, i: F.concat(F.when(i == 0, F.lit("first:")).otherwise(F.lit("path:")), x))
    extension = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.split(x, "=").getItem(0)))
    parts = F.transform(F.reverse(labels), lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x))
    several = F.concat(parts, named, F.array(F.concat(F.lit("kind:"), extension)), keys)
    return F.array_sort(F.array_distinct(F.filter(several, lambda x: ~F.endswith(x, F.lit(":")))))


def sure_share(bad: Column, pages: Column) -> Column:
    """The lower end of the Wilson interval of the share ``bad / pages``."""
    share, spread = bad / pages, Z * Z / pages
    return (share + spread / 2 - Z * F.sqrt((share * (1 - share) + spread / 4) / pages)) / (1 + spread)


def needed_bad(least: int, confidence: float) -> int:
    """The bad pages that every rule has: fewer are not sure enough on ``least`` pages, nor on more."""
    def sure(bad: int, pages: int) -> float:
        share, spread = bad / pages, Z * Z / pages
        return (share + spread / 2 - Z * (share * (1 - share) / pages + spread / (4 * pages)) ** 0.5) / (1 + spread)

    enough = [bad for bad in range(1, least + 1) if sure(bad, least) >= confidence]
    return enough[0] if enough else max(least, int(confidence * Z * Z / (1 - confidence)))


def token_classes(baskets: DataFrame, least: int) -> DataFrame:
    """(token, item) of the tokens on ``least`` pages or more; tokens on exactly the same pages are one item."""
    page = F.xxhash64("page_id", "copy")
    seen = baskets.select(page.alias("page"), F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("pages"), F.bit_xor("page").alias("x"), F.sum(F.col("page").cast("decimal(20,0)")).alias("s")).where(F.col("pages") >= least)
    return seen.groupBy("pages", "x", "s").agg(F.min("token").alias("item"), F.collect_set("token").alias("tokens")).select(
        F.explode("tokens").alias("token"), "item")


def mined_rules(pages: DataFrame, labels: DataFrame, least: int = LEAST_PAGES, confidence: float = CONFIDENCE
                ) -> tuple[DataFrame, DataFrame]:
    """The block rules (tokens, rarest, confidence; tokens stand for their class) and the classes (token, item).

    ``pages``: page_id, tokens; ``labels``: doc_id, quality, toxic.
    """
    bad = (F.coalesce(F.max("toxic"), F.lit(0)) == 1) | (F.coalesce(F.min("quality"), F.lit(1)) == 0)
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(bad.alias("bad"))
    rows = pages.join(marked, "page_id").where(F.size("tokens") > 0)
    baskets = written(rows.select("page_id", F.monotonically_increasing_id().alias("copy"), "tokens", "bad"), "baskets")
    classes = written(token_classes(baskets, least), "classes")
    number = baskets.count()
    if number < least:
        return rows.sparkSession.createDataFrame([], "tokens array<string>, confidence double, rarest string"), classes
    items = baskets.select("page_id", "copy", "bad", F.explode("tokens").alias("token")).join(classes, "token").groupBy(
        "page_id", "copy", "bad").agg(F.collect_set("item").alias("items"))
    items = items.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, needed_bad(least, confidence) / number)).fit(items)
    found = written(model.freqItemsets, "itemsets")
    with_bad = found.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("bad"))
    alone = found.where(~F.array_contains("items", BAD) & (F.col("freq") >= least)).select(
        F.array_sort("items").alias("tokens"), F.col("freq").alias("pages"))
    rules = with_bad.join(alone, "tokens").withColumn("confidence", sure_share(F.col("bad"), F.col("pages"))).where(
        F.col("confidence") >= confidence).select("tokens", "confidence")
    general = rules.select(F.element_at("tokens", 1).alias("token"), F.col("tokens").alias("wide"), F.col("confidence").alias("c"))
    covered = (rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(general, "token")
               .where((F.size("wide") < F.size("tokens")) & (F.size(F.array_except("wide", "tokens")) == 0) & (F.col("c") >= F.col("confidence")))
               .select("tokens").distinct())
    pruned = rules.join(covered, "tokens", "left_anti")
    single = found.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq"))
    seen = pruned.select("tokens", "confidence", F.explode("tokens").alias("token")).join(single, "token")
    return seen.groupBy("tokens", "confidence").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest")), classes


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, ``mined`` (tokens of a mined rule that blocks it)."""
    host, path = host_and_path()
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"),
                       F.when(F.col("host") != "", url_tokens()).otherwise(F.array().cast("array<string>")).alias("tokens"))
    found, classes = mined_rules(rows.select("page_id", "tokens"), labels)
    found = written(found, "rules")
    used = found.select(F.explode("tokens").alias("item")).distinct()
    names = {r.token: r.item for r in classes.join(used, "item").collect()}  # on LEAST_PAGES labelled pages each
    # tokens as their class's item; others match no rule
    named = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.lit, names.values()))) if names else None
    items = (F.array_sort(F.array_distinct(F.filter(F.transform("tokens", lambda x: F.try_element_at(named, x)), lambda x: x.isNotNull())))
             if names else F.array().cast("array<string>"))
    rows = rows.withColumn("tokens", items)
    sets = rows.where("fixed is null and size(tokens) > 0").select("tokens").distinct()
    hits = (sets.select("tokens", F.explode("tokens").alias("rarest"))
            .join(found.withColumnRenamed("tokens", "needed"), "rarest")
            .where(F.size(F.array_except("needed", "tokens")) == 0)
            .groupBy("tokens").agg(F.max_by("needed", F.struct("confidence", F.size("needed"), "needed")).alias("mined")))
    return rows.join(hits, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", F.when(F.col("mined").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("mined")).alias("mined"))


def contract(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op3."""
    return judged(pages, labels).select("page_id", "host", "path", "rule", "verdict")
