"""URL filters: fixed host and path rules, then association rules mined from labelled pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ITEM = "label=block"
#: Share of the labelled pages a rule must cover, and share of these that must be bad.
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.8
#: Labelled pages a rule must cover at least, whatever their share.
LEAST_PAGES = 20


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: ``h:`` labels of the host, ``p:`` words of the path, ``q:`` names of the query."""
    words = lambda text, pattern, mark: F.transform(F.filter(F.split(text, pattern), lambda w: w.rlike("[^0-9]")), lambda w: F.concat(F.lit(mark), w))
    query = F.regexp_extract_all(F.regexp_extract(url, r"[?]([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), 1)
    return F.coalesce(
        F.array_distinct(F.concat(words(host(url), "[.]", "h:"), words(path(url), "[/._-]", "p:"), F.transform(query, lambda q: F.concat(F.lit("q:"), q)))),
        F.array().cast("array<string>"),
    )


def fixed_rule(url: Column, rules: tuple[Rule, ...], field: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits the url; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # a later, longer one takes precedence
        fits = ((host(url) == rule.host) | host(url).endswith("." + rule.host)) & path(url).startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def mine(pages: DataFrame, labels: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(tokens, size, confidence, support, anchor): token combinations that labels say are bad.

    FP-growth over the token sets of labelled pages, a bad page's with one
    more item; rules that lead to that item with at least ``confidence`` and
    ``support`` (and ``least_pages`` pages) stay, unless a rule on some of
    their tokens is as confident. ``anchor`` is the rule's rarest token. No
    labelled pages: no rules.
    """
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    baskets = pages.select(F.col("page_id").alias("doc_id"), tokens(F.col("url")).alias("items")).join(marked, "doc_id")
    baskets = baskets.select(F.when(F.col("bad"), F.array_append("items", F.lit(BLOCK_ITEM))).otherwise(F.col("items")).alias("items"))
    pages_labelled = baskets.count()
    support = min(1.0, max(support, least_pages / max(1, pages_labelled)))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.filter(F.array_contains("consequent", BLOCK_ITEM)).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = rules.filter(F.round(F.col("support") * pages_labelled) >= least_pages)
    rules = rules.withColumns({"size": F.size("tokens"), "rule": F.array_join("tokens", " ")})
    simpler = rules.select(F.col("tokens").alias("part"), F.col("size").alias("part_size"), F.col("confidence").alias("as_sure"), F.element_at("tokens", 1).alias("token"))
    implied = rules.select("rule", "tokens", "size", "confidence", F.explode("tokens").alias("token")).join(simpler, "token")
    implied = implied.filter((F.col("part_size") < F.col("size")) & (F.col("as_sure") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0))
    rules = rules.join(implied.select("rule").distinct(), "rule", "left_anti")
    single = model.freqItemsets.filter("size(items) = 1").select(F.element_at("items", 1).alias("token"), "freq")
    anchor = rules.select("rule", F.explode("tokens").alias("token")).join(single, "token").groupBy("rule").agg(F.min(F.struct("freq", "token"))["token"].alias("anchor"))
    return rules.join(anchor, "rule").select("tokens", "size", "confidence", "support", "anchor")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` values that hold all tokens of some rule.

    Inverted index: a rule is listed under its rarest token, a url looks up
    each of its tokens and checks the few rules listed there.
    """
    listed = urls.filter("url IS NOT NULL").select("url").distinct().withColumn("mine", tokens(F.col("url")))
    found = listed.select("url", "mine", F.explode("mine").alias("anchor")).join(rules.select("anchor", F.col("tokens").alias("needed")), "anchor")
    return found.filter(F.size(F.array_except("needed", "mine")) == 0).select("url").distinct()


def judge(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    ``rule`` is the longest fixed rule that fits the host (or a domain above
    it) and starts the path, else null; its verdict counts. Others are
    blocked if a mined rule matches the url, else allowed. A null url or one
    without ``://`` has an empty host and path. A page's label is that of the
    doc_id equal to its page_id (bad if any of its labels has quality 0; null
    labels and ids are ignored). Repeated rows are judged alike; empty tables
    give no rows or no mined rules. Other columns are ignored.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    mined = mine(pages, labels, support, confidence, least_pages)
    bad = matched(pages, mined).withColumn("mined", F.lit("block"))
    url = F.col("url")
    return pages.join(bad, "url", "left").select(
        "page_id", host(url).alias("host"), path(url).alias("path"), fixed_rule(url, rules, "name").alias("rule"),
        F.coalesce(fixed_rule(url, rules, "verdict"), "mined", F.lit("allow")).alias("verdict"),
    )
