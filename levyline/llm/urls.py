"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule decides.

The trees learn from labelled URLs (here those that a rule decides) on at most `TRAIN_ROWS` of them, taken by lowest hash.
Block rates and counts of suffixes are those of all labelled URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRAIN_ROWS = 20_000  # documented bound of the labelled sample
FOLDS = 5  # of hosts; a training row's suffix rate comes from the other folds
PRIOR_ROWS = 5.0  # weight of the overall block rate in a suffix's rate
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters",
    "query_length", "has_fragment", "is_https", "suffix_rate", "suffix_rows",
]


@dataclass(frozen=True)
class Rule:
    """`pattern` is a host suffix followed by the start of a path, as in example.com/en/."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.split("/", 1)[1]


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The pattern of the longest rule that fits, else null. A rule fits its host and every subdomain of it."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(r.pattern))
        for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    bits = F.aggregate(F.array_distinct(F.split(text, "", -1)), F.lit(0.0), lambda acc, c: acc - F.when(
        (c != "") & (share(c) > 0), share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def suffix_of(host: Column) -> Column:
    """The host's last two labels, the last one first."""
    return F.concat_ws(".", F.slice(F.reverse(F.split(host, r"\.")), 1, 2))


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the features that need nothing but the url; the suffix is the host's last two labels."""
    url, rest = F.coalesce("url", F.lit("")), F.substring_index(F.coalesce("url", F.lit("")), "#", 1)
    query = F.when(rest.contains("?"), F.regexp_extract(rest, r"(?s)\?(.*)$", 1)).otherwise("")
    return pages.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")).cast("double"),
        "labels": F.size(F.split("host", r"\.")).cast("double"),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double"),
        "entropy": _entropy(url), "query_length": F.length(query).cast("double"),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
        "has_fragment": F.when(url.contains("#"), 1.0).otherwise(0.0),
        "is_https": F.when(url.startswith("https:"), 1.0).otherwise(0.0),
        "suffix": suffix_of(F.col("host")),
    })


def _fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS))


def _with_suffix_rates(rows: DataFrame, stats: DataFrame, overall: float, folds: DataFrame | None = None) -> DataFrame:
    """Block rate and row count of the suffix among the labelled rows.

    With `folds` (suffix, fold, f_rows, f_blocked) the rows are training rows, and each gets the rate of the other folds: a
    rate that holds a row's own label, or leaves just that one out, would tell the label.
    """
    joined = rows.join(stats, "suffix", "left")
    n, blocked = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_blocked", F.lit(0))
    if folds is not None:
        joined = joined.withColumn("fold", _fold(F.col("host"))).join(folds, ["suffix", "fold"], "left")
        n, blocked = n - F.coalesce("f_rows", F.lit(0)), blocked - F.coalesce("f_blocked", F.lit(0))
    return joined.withColumns({
        "suffix_rate": (blocked + F.lit(PRIOR_ROWS * overall)) / (n + F.lit(PRIOR_ROWS)), "suffix_rows": F.log1p(n.cast("double")),
    }).drop("n_rows", "n_blocked", "f_rows", "f_blocked", "fold")


def judge(pages: DataFrame, rules: Sequence[Rule], train_rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of `pages` (page_id, url; other columns are left out).

    verdict is the rule's, else block where the trees give a probability (score) of a half or more. score is null where a
    rule decides. A null url, or one without ://, has empty host and path and is judged by the trees. Without two kinds
    of labelled rows there is nothing to learn: what no rule decides is allowed with score 0. Repeated rows stay repeated.
    """
    verdict_of = F.create_map(*[F.lit(x) for r in rules for x in (r.pattern, r.verdict)]) if rules else None
    base = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    base = base.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    decided = verdict_of[F.col("rule")] if rules else F.lit(None).cast("string")
    out = base.withColumn("decided", decided)
    labelled = out.filter("rule IS NOT NULL").withColumn("label", (F.col("decided") == "block").cast("double"))
    counted = labelled.groupBy(suffix_of(F.col("host")).alias("suffix"), _fold(F.col("host")).alias("fold")).agg(
        F.count("*").alias("f_rows"), F.sum("label").alias("f_blocked"))
    folds = written(counted, "url-folds")  # a few rows per suffix: Spark chooses the joins
    stats = written(folds.groupBy("suffix").agg(F.sum("f_rows").alias("n_rows"), F.sum("f_blocked").alias("n_blocked")), "url-suffixes")
    n, blocked = stats.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("n_blocked"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return out.select("page_id", "host", "path", "rule", F.coalesce("decided", F.lit("allow")).alias("verdict"),
                          F.when(F.col("rule").isNull(), 0.0).alias("score"))
    overall = blocked / n
    # only the fit uses a sample
    sample = labelled.orderBy(F.xxhash64("url", "page_id"), "page_id", "url").limit(train_rows)
    train = written(lexical(sample), "url-train")
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    ready = assemble.transform(_with_suffix_rates(train, stats, overall, folds)).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, subsamplingRate=0.8).fit(ready)
    open_rows = _with_suffix_rates(lexical(out.filter("rule IS NULL")), stats, overall)
    scored = model.transform(assemble.transform(open_rows)).select(
        "page_id", "host", "path", "rule", vector_to_array("probability")[1].alias("score"))
    by_model = scored.select("page_id", "host", "path", "rule", F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score")
    by_rule = out.filter("rule IS NOT NULL").select(
        "page_id", "host", "path", "rule", F.col("decided").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return by_rule.unionByName(by_model)
