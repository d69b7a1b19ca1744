"""Operator 9, URL filters: host and path rules, then gradient-boosted trees on lexical features. JVM side only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Host words of sites that publish little but advertising; a host that holds one is labelled 1, any other not yet.
SEED_WORDS = ("spam", "casino", "pills", "poker", "payday", "replica", "viagra", "xxx")

FEATURES = (
    "url_length", "host_length", "path_length", "host_labels", "path_depth", "digit_ratio", "host_digits", "hyphens",
    "host_hyphens", "entropy", "host_entropy", "n_params", "query_length", "has_fragment", "has_extension",
    "longest_label", "suffix_rows", "suffix_rate",
)
LEXICAL = FEATURES[:-2]


@dataclass(frozen=True)
class UrlModelRules:
    """sample_rows, if set, bounds the labelled URLs that the trees are fitted on; all else counts all URLs.

    broadcast_rows: suffixes up to this number are broadcast to the URLs; more are joined by shuffling both.

    folds: groups of seed words of which each is kept from one model of what seeds look like. alike: share of a group
    that sets its mark. rounds: times that the models are fitted anew without the URLs found so far. features: what each
    split of a tree chooses from, so that the trees do not all hang on one of several features that seeds share. grain:
    log odds are counted in steps of this size, relative beyond 1, to find their percentiles.
    """

    sample_rows: int | None = None
    trees: int = 20
    depth: int = 4
    step: float = 0.2
    suffix_prior: float = 20.0
    broadcast_rows: int = 200_000
    block_at: float = 0.5
    seed: int = 7
    folds: int = 4
    alike: float = 0.95
    ridge: float = 0.01
    rounds: int = 3
    features: str = "onethird"
    grain: float = 1e-4


def host_of(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, what).otherwise(verdict)
    return text, verdict


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits a character, over a-z, 0-9, and any other."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    total, other = F.lit(0.0), size
    for sign in LOWER + "0123456789":
        n = (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("double")
        total = total - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0)
        other = other - n
    return total - F.when(other > 0, other / size * F.log2(other / size)).otherwise(0.0)


def _suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def lexical(urls: DataFrame) -> DataFrame:
    """urls(url, host, path, ...) with FEATURES but for the suffix statistics, and _suffix."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1))
    return urls.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "host_labels": F.size(F.split(host, r"\.")).cast("double"),
            "path_depth": _count(path, "/"),
            "digit_ratio": _count(url, "[0-9]") / size,
            "host_digits": _count(host, "[0-9]"),
            "hyphens": _count(url, "-"),
            "host_hyphens": _count(host, "-"),
            "entropy": _entropy(F.translate(url, UPPER, LOWER)),
            "host_entropy": _entropy(host),
            "n_params": F.when(query == "", 0.0).otherwise(1.0 + _count(query, "&")),
            "query_length": F.length(query).cast("double"),
            "has_fragment": F.when(url.contains("#"), 1.0).otherwise(0.0),
            "has_extension": F.when(path.rlike(r"\.[A-Za-z0-9]+$"), 1.0).otherwise(0.0),
            "longest_label": F.coalesce(F.array_max(F.transform(F.split(host, r"[.-]"), F.length)), F.lit(0)).cast("double"),
            "_suffix": _suffix_of(host),
        }
    )


@dataclass
class UrlModel:
    """suffixes(_key, _n, _ones): a row for every suffix of the labelled URLs; small: few enough to broadcast."""

    suffixes: DataFrame
    small: bool
    trees: GBTClassificationModel
    rate: float
    rules: UrlModelRules

    def score(self, urls: DataFrame) -> DataFrame:
        """urls(url, host, path, ...) with score, the trees' probability that the label is 1."""
        rows = urls.select("url", "host", "path", F.struct(*urls.columns).alias("_row"))
        rows = _with_suffix(lexical(rows), self.suffixes, self.small, self.rate, self.rules.suffix_prior)
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
        rows = self.trees.transform(rows.select("_row", "_features"))
        return rows.select("_row.*", vector_to_array("probability").getItem(1).alias("score"))


def _with_suffix(rows: DataFrame, suffixes: DataFrame, small: bool, rate: float, prior: float, own: Column | None = None) -> DataFrame:
    """rows with the suffix statistics; own is a row's own label, which its suffix's must not hold when trees learn from it."""
    suffixes = F.broadcast(suffixes) if small else suffixes
    n, ones = F.coalesce("_n", F.lit(0)), F.coalesce("_ones", F.lit(0.0))
    if own is not None:
        n, ones = n - 1, ones - own
    out = rows.join(suffixes, F.col("_suffix") == F.col("_key"), "left")
    return out.withColumns({"suffix_rows": F.log1p(n), "suffix_rate": (ones + prior * rate) / (n + prior)}).drop("_key", "_n", "_ones")


def train(labelled: DataFrame, rules: UrlModelRules = UrlModelRules()) -> UrlModel | None:
    """Trees from labelled(url, host, path, label); None if the labels are all alike, or there are none.

    Suffixes are counted over all labelled URLs, for each URL that the trees learn from without itself. The trees are
    fitted on all of them too, or on the sample_rows first by hash of the URL if rules say so. Null labels are left out.
    """
    scratch = Scratch(labelled.sparkSession, "urls")
    known = labelled.filter(F.col("label").isNotNull())
    known = scratch.save(known.select("url", "host", "path", F.col("label").cast("double").alias("label")), "labelled")
    all_rows, all_ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < all_ones < all_rows:
        return None
    rate, prior = all_ones / all_rows, rules.suffix_prior
    suffixes = known.groupBy(_suffix_of(F.col("host")).alias("_key")).agg(F.count("*").alias("_n"), F.sum("label").alias("_ones"))
    suffixes = scratch.save(suffixes, "suffixes")
    small = suffixes.count() <= rules.broadcast_rows
    try:
        some, n, positive = known, all_rows, all_ones
        if rules.sample_rows is not None:
            some = known.orderBy(F.xxhash64("url"), "url", "label").limit(rules.sample_rows)
            n, positive = some.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        if not 0 < positive < n:
            return None
        rows = _with_suffix(lexical(some), suffixes, small, rate, prior, F.col("label"))
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
        # Both labels weigh the same: how many URLs the seed words happen to name says nothing about the others.
        weight = F.when(F.col("label") == 1, (n - positive) / positive).otherwise(1.0)
        # Saved, as the trees' fit reads the rows more than once.
        rows = scratch.save(rows.select("_features", "label", weight.alias("_weight")), "features")
        trees = GBTClassifier(
            featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=rules.trees, maxDepth=rules.depth,
            stepSize=rules.step, featureSubsetStrategy=rules.features, seed=rules.seed,
        ).fit(rows)
        return UrlModel(suffixes, small, trees, rate, rules)
    finally:
        scratch.keep(suffixes)


def looks_seeded(rows: DataFrame, rules: UrlModelRules) -> Column:
    """Whether a row looks like the seeds. rows(url, lexical, word): LEXICAL as an array; null words for unseeded URLs.

    For each group of words, logistic regression tells the other groups' URLs from the unseeded ones, which are bad ones
    in part. A URL looks like the seeds if it lies beyond the middle between the unseeded URLs' median and the mark that
    most URLs of the words unknown to the model reach; the next round learns without such URLs. With one word alone, the
    URLs learned from set the mark. Models, medians and marks are those of all rows, which are read again for each.
    """
    seeds = {r.word: r["count"] for r in rows.groupBy("word").count().collect()}
    plain, words = seeds.pop(None, 0), sorted(seeds)
    out = F.lit(False)
    if not plain or not words:
        return out
    n, left_out = min(rules.folds, len(words)), 0
    for _ in range(rules.rounds):
        left = rows.filter(F.col("word").isNotNull() | ~out)
        found = out
        for fold in range(n):
            unseen = words[fold::n] if n > 1 else []
            learned = [w for w in words if w not in unseen]
            margin = _margin(left, learned, plain / sum(seeds[w] for w in learned), rules)
            middle, mark = _middle_and_mark(rows, margin, unseen or learned, rules)
            if mark > middle:
                found = found | (margin > (middle + mark) / 2)
        out = found
        before, left_out = left_out, rows.filter(F.col("word").isNull() & out).count()
        if left_out in (before, plain):
            break
    return out


def _middle_and_mark(rows: DataFrame, margin: Column, words: list[str], rules: UrlModelRules) -> tuple[float, float]:
    """Median margin of the URLs without a word, and the margin that the share alike of the words' URLs reaches.

    Margins are counted in steps of grain, so that no task holds a value for each row.
    """
    rows = rows.filter(F.col("word").isNull() | F.col("word").isin(words))
    step = F.round(F.signum(margin) * F.log1p(F.abs(margin)) / rules.grain).cast("long")
    counts = rows.groupBy(F.col("word").isNull().alias("plain"), step.alias("step")).agg(F.count("*").alias("n"))
    value = F.signum("step") * F.expm1(F.abs("step") * rules.grain)
    middle = F.percentile(F.when(F.col("plain"), value), 0.5, F.col("n"))
    mark = F.percentile(F.when(~F.col("plain"), value), 1 - rules.alike, F.col("n"))
    return counts.agg(middle, mark).first()


def _margin(left: DataFrame, learned: list[str], weight: float, rules: UrlModelRules) -> Column:
    """Log odds, over LEXICAL, of URLs of the learned words against those without a word."""
    fit = left.filter(F.col("word").isNull() | F.col("word").isin(learned))
    label = F.col("word").isNotNull().cast("double")
    fit = fit.select(array_to_vector("lexical").alias("features"), label.alias("label"), F.when(label == 1, weight).otherwise(1.0).alias("weight"))
    model = LogisticRegression(weightCol="weight", regParam=rules.ridge).fit(fit)
    # One expression over arrays for all models: sums of columns would be compiled anew for each.
    times = F.array(*[F.lit(float(x)) for x in model.coefficients.toArray()])
    return F.aggregate(F.zip_with("lexical", times, lambda x, y: x * y), F.lit(float(model.intercept)), lambda a, x: a + x)


def labelled(rows: DataFrame, rules: UrlModelRules) -> DataFrame:
    """rows(url, host, path, word) with label: 1 for a seed, null for a URL that looks like one, 0 for the others."""
    scratch = Scratch(rows.sparkSession, "urls-lexical")
    # Saved, as the models read the features again and again.
    rows = scratch.save(lexical(rows).select("url", "host", "path", "word", F.array(*LEXICAL).alias("lexical")), "lexical")
    label = F.when(F.col("word").isNotNull(), 1).when(~looks_seeded(rows, rules), 0)
    return rows.select("url", "host", "path", label.alias("label"))


def judge(
    pages: DataFrame, rules=RULES, model_rules: UrlModelRules = UrlModelRules(), words: Sequence[str] = SEED_WORDS
) -> DataFrame:
    """Each row of pages(page_id, url) with host, path, rule, score and verdict.

    A rule's verdict stands; the trees judge the other URLs, and learn from those alone: label 1 if the host holds a
    seed word, none if the URL looks like those, else 0. Null URLs and those without :// have an empty host and path, and
    are scored like any other; if labels are all alike, what no rule decides is allowed. Repeated rows are judged one by
    one; other columns are ignored.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_verdict": verdict})
    word = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("host").contains(w), F.lit(w)) for w in words])
    open_rows = rows.filter(F.col("url").isNotNull() & F.col("_verdict").isNull())
    open_rows = open_rows.select("url", "host", "path", word.alias("word"))
    model = train(labelled(open_rows, model_rules), model_rules)
    rows = model.score(rows) if model else rows.withColumn("score", F.lit(0.0))
    learned = F.when(F.col("score") >= model_rules.block_at, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", "score", F.coalesce("_verdict", learned).alias("verdict"))
