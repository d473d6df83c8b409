"""URL verdicts from listed rules and from association rules mined from labels.

A listed rule names a host and a path; it fits the host and its subdomains if
the path starts with the rule's, and the longest fitting rule decides.

Where no listed rule fits, mined rules do. A URL becomes a set of tokens (scheme,
host labels, path words, query keys). FP-growth over the labelled pages finds
frequent token combinations together with the label; a combination is a rule if
its confidence and support reach the bounds, if as many blocked pages would hardly be
met by chance, and if no part of it is as confident. Chance is a binomial tail at the
share of blocked pages, by its Chernoff bound, times the number of combinations tried:
where labels say nothing about URLs no rule is found, and a token on a few pages, all
of them blocked, is one.
Rules match through an inverted index: each rule is filed under its rarest token,
a page looks up its tokens there, and a hit must hold the rule's other tokens.
The most confident hit decides; without one the page is allowed.

Defined results: a null URL or one without ``://`` has empty host and path and
no tokens but still gets a verdict; repeated rows get one verdict each; without
labelled pages there are no mined rules; a page with several labels is blocked
if one says so. Only the named columns are read.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.llm.common import key_columns, stage

BLOCK = "label=block"


@dataclass(frozen=True)
class ListedRule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Mining:
    #: Least share of the labelled pages, which bounds the combinations tried on large tables.
    support: float = 0.0005
    confidence: float = 0.6
    #: Pages that a rule must hold on, however few are labelled.
    pages: int = 4
    #: Chance that a table without any association gives a rule at all.
    chance: float = 0.01


LISTED = (
    ListedRule("block", "net", "/"),
    ListedRule("allow", "example.net", "/en/"),
    ListedRule("block", "example.com", "/de/"),
    ListedRule("allow", "org", "/fr/"),
)


def url_parts(url: str) -> dict[str, Column]:
    """Host with ASCII letters in lower case, path, and what follows, of a URL column."""
    rest = F.when(
        F.locate("://", F.col(url)) > 0,
        F.substring(F.col(url), F.locate("://", F.col(url)) + F.lit(3), F.length(url)),
    ).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return {
        "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        "_query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
        "_scheme": F.when(F.locate("://", F.col(url)) > 0, F.substring_index(F.col(url), "://", 1)),
    }


def url_tokens() -> Column:
    """Token set of a row with the columns of ``url_parts``; digits do not make a word."""

    def marked(mark: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    query_keys = F.transform(F.split("_query", "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(
        F.concat(
            marked("s:", F.array(F.coalesce(F.lower("_scheme"), F.lit("")))),
            marked("h:", F.split("host", r"\.")),
            marked("p:", F.split(F.lower("path"), r"[^\p{L}]+")),
            marked("q:", query_keys),
        )
    )


def fitting_rule(rules: tuple[ListedRule, ...]) -> Column:
    """The longest listed rule that fits, as a struct, or null."""
    listed = F.array(
        *(
            F.struct(
                F.lit(r.host).alias("host"),
                F.lit(r.path).alias("path"),
                F.lit(r.text).alias("text"),
                F.lit(r.action).alias("action"),
            )
            for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
        )
    )
    fits = F.filter(
        listed,
        lambda r: ((F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"])))
        & F.startswith(F.col("path"), r["path"]),
    )
    return F.get(fits, F.lit(0))


def log_chance(n: Column, share: Column, base: float) -> Column:
    """Logarithm of a bound on the chance that of ``n`` pages at least ``share`` are blocked, at rate ``base``.

    Chernoff's bound on the binomial tail, zero where the share is no more than the rate.
    """
    if base >= 1:
        return F.lit(0.0)
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / F.lit(1 - base))).otherwise(0.0)
    return F.when(share > base, -n * (share * F.log(share / F.lit(base)) + rest)).otherwise(0.0)


def mined_rules(tokens: DataFrame, labels: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules (antecedent, confidence, support, key) that lead to blocking.

    ``tokens`` has ``id`` and ``tokens``; ``labels`` has ``id`` and ``blocked``.
    """
    one_label = labels.groupBy("id").agg(F.max("blocked").alias("blocked"))
    baskets = stage(
        tokens.join(one_label, "id").select(
            F.concat("tokens", F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array())).alias("items")
        ),
        "url_baskets",
    )
    labelled, blocked = baskets.agg(F.count("*"), F.count_if(F.array_contains("items", BLOCK))).first()
    if not blocked:
        return tokens.sparkSession.createDataFrame(
            [], "antecedent array<string>, confidence double, support double, key string"
        )
    support = min(1.0, max(mining.support, mining.pages / labelled))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=mining.confidence).fit(baskets)
    tried = model.freqItemsets.where(~F.array_contains("items", BLOCK)).count()
    on = F.round(F.col("support") * labelled / F.col("confidence"))
    rules = stage(
        model.associationRules.where(F.array_contains("consequent", BLOCK))
        .where(log_chance(on, F.col("confidence"), blocked / labelled) + math.log(max(tried, 1)) <= math.log(mining.chance))
        .select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support"),
        "url_rules",
    )
    # A rule is redundant if leaving out one token loses no confidence.
    shorter = rules.select(
        "antecedent",
        "confidence",
        F.explode(F.transform("antecedent", lambda t: F.array_remove("antecedent", t))).alias("part"),
    )
    kept = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    redundant = shorter.join(kept, "part").where("part_confidence >= confidence").select("antecedent")
    pruned = rules.join(redundant, "antecedent", "left_anti")
    singles = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    filed = pruned.select("*", F.explode("antecedent").alias("token")).join(singles, "token")
    return filed.groupBy("antecedent", "confidence", "support").agg(
        F.min(F.struct("freq", "token"))["token"].alias("key")
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[ListedRule, ...] = LISTED,
    mining: Mining = Mining(),
    page_id="page_id",
    url="url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and the mined rule that decided."""
    parsed = stage(
        pages.select(
            *key_columns(page_id, url),
            F.col(page_id).alias("page_id"),
            *(c.alias(n) for n, c in url_parts(url).items()),
        ).select("_k1", "_k2", "page_id", "host", "path", url_tokens().alias("_tokens")),
        "url_parsed",
    )
    found = stage(
        mined_rules(parsed.select(F.col("page_id").alias("id"), F.col("_tokens").alias("tokens")), labels, mining),
        "url_index",
    )
    hits = (
        parsed.select("_k1", "_k2", "_tokens", F.explode("_tokens").alias("key"))
        .join(found, "key")
        .where(F.forall("antecedent", lambda t: F.array_contains("_tokens", t)))
        .groupBy("_k1", "_k2")
        .agg(F.max(F.struct("confidence", "support", F.concat_ws(" ", "antecedent").alias("rule"))).alias("_best"))
    )
    listed = parsed.withColumn("_rule", fitting_rule(rules)).join(stage(hits, "url_hits"), ["_k1", "_k2"], "left")
    return listed.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce(
            F.col("_rule.action"), F.when(F.col("_best").isNotNull(), "block").otherwise("allow")
        ).alias("verdict"),
        F.when(F.col("_rule").isNull(), F.col("_best.rule")).alias("mined_rule"),
    )


def page_labels(labels: DataFrame) -> DataFrame:
    """Labels by id: toxic or of low quality means blocked."""
    return labels.select(
        F.col("doc_id").alias("id"),
        (F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))).alias("blocked"),
    )
