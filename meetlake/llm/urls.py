"""URL filters: rules first, gradient-boosted trees for the rest (operator 8).

A rule names a host and the beginning of a path and holds for the host and its subdomains;
of several that fit, the longest wins. URLs without a rule are judged by gradient-boosted
trees on lexical features: lengths, depth, digit ratio, entropy, parameter, hyphen and
label counts, and how often labelled URLs with the same host suffix, top-level domain or
first path segment are blocked. The trees learn from the URLs that rules label, at most
`SAMPLE_ROWS` of them; the statistics count all of them. For a labelled URL they leave out its
own fold, so that no URL, nor a copy of it, tells the trees its own label.

Defined results: a null URL or one without `://` has an empty host and path and no rule, and is
judged like any other; an empty table gives no rows; if the labelled URLs are all of one class, that
class is the verdict, and without any the verdict is allow. Repeated rows get equal results.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetlake.llm.common import bounded_sample
from meetlake.session import staged

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE = 20, 5, 0.2
SMOOTHING, FOLDS = 5.0, 5
SUFFIXES = ("suffix", "tld", "segment")
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "digits", "entropy", "parameters",
    "hyphens", "labels", "is_secure", "has_fragment",
)


@dataclass(frozen=True)
class Rule:
    text: str  # host/path
    verdict: str  # allow or block

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        on_host = (host == name) | host.endswith("." + name)
        return on_host & path.startswith("/" + rest)


RULES = (
    Rule("com/en/", "block"),
    Rule("example.com/en/7", "allow"),
    Rule("net/de/", "allow"),
    Rule("example.net/de/8", "block"),
    Rule("org/es/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower-case A-Z and path of a URL; both empty where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def ruled(rules: tuple[Rule, ...], host: Column, path: Column, what: str) -> Column:
    """`text` or `verdict` of the longest rule that fits, null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(
        *[F.when(r.fits(host, path), F.lit(getattr(r, what))) for r in ordered], F.lit(None)
    ).cast("string")


def _share_log(n: Column, total: Column) -> Column:
    return F.when(n > 0, n / total * F.log2(n / total)).otherwise(0.0)


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the lexical features and the keys of the statistics to (url, host, path)."""
    url, host, path = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "host", "path"))
    size = F.length(url)
    # entropy over character classes that occur in URLs: each letter and digit, and the rest
    counts = [
        size - F.length(F.translate(F.lower(url), c, ""))
        for c in string.ascii_lowercase + string.digits + "/.-?=&#:_%"
    ]
    entropy = -reduce(lambda a, b: a + b, [_share_log(n, size) for n in counts])
    digits = size - F.length(F.translate(url, string.digits, ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.split(host, r"\.")
    return rows.select(
        "*",
        size.cast("double").alias("url_length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("depth"),
        F.when(size > 0, digits / size).otherwise(0.0).alias("digits"),
        F.when(size > 0, entropy).otherwise(0.0).alias("entropy"),
        F.regexp_count(query, F.lit("[^&]+")).cast("double").alias("parameters"),
        F.regexp_count(url, F.lit("-")).cast("double").alias("hyphens"),
        F.size(parts).cast("double").alias("labels"),
        url.startswith("https:").cast("double").alias("is_secure"),
        url.contains("#").cast("double").alias("has_fragment"),
        F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), 2), ".").alias("suffix"),
        F.element_at(parts, -1).alias("tld"),
        F.regexp_extract(path, "^/([^/]*)", 1).alias("segment"),
    )


def _counts(labelled: DataFrame, key: str) -> DataFrame:
    """Labelled and blocked URLs per key and fold; one row per key."""
    folds = [F.col("fold") == k for k in range(FOLDS)]
    return labelled.groupBy(key).agg(
        F.array(*[F.count_if(f) for f in folds]).alias("n"),
        F.array(*[F.count_if(f & (F.col("label") == 1)) for f in folds]).alias("b"),
    )


def rated(rows: DataFrame, prior: float) -> DataFrame:
    """Adds per statistic the smoothed share of blocked URLs with the same key.

    `rows` are staged and have url and label (1 blocked, 0 allowed, null not labelled).
    """
    full = rows.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))
    labelled = full.filter(F.col("label").isNotNull())

    def others(c: str) -> Column:
        own = F.when(F.col("label").isNotNull(), F.get(c, F.col("fold"))).otherwise(0)
        return reduce(Column.__add__, [F.get(c, F.lit(k)) for k in range(FOLDS)]) - own

    for key in SUFFIXES:
        rate = (others("b") + prior * SMOOTHING) / (others("n") + SMOOTHING)
        met = full.join(staged(_counts(labelled, key), f"url-{key}"), key, "left")
        full = met.withColumn(f"{key}_rate", F.coalesce(rate, F.lit(prior))).drop("n", "b")
    return full.drop("fold")


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id="page_id", url="url"):
    """Per row: page_id, host, path, rule, verdict, and score (of the trees; null with a rule)."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )
    here = F.col("host"), F.col("path")
    rows = rows.withColumn("rule", ruled(rules, *here, "text")).withColumn(
        "ruled", ruled(rules, *here, "verdict")
    )
    rows = rows.withColumn("label", (F.col("ruled") == "block").cast("double"))
    rows = staged(lexical(rows), "urls")
    labelled = rows.filter(F.col("label").isNotNull())
    by_class = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(by_class) < 2:
        only = "block" if 1.0 in by_class else "allow"
        verdict = F.coalesce("ruled", F.lit(only))
        return rows.select(
            "page_id", "host", "path", "rule", verdict.alias("verdict"),
            F.lit(None).cast("double").alias("score"),
        )
    prior = by_class[1.0] / sum(by_class.values())
    full = rated(rows, prior)
    wanted = [*FEATURES, *(f"{k}_rate" for k in SUFFIXES)]
    vectors = VectorAssembler(inputCols=wanted, outputCol="features").transform(full)
    fitting = full.filter(F.col("label").isNotNull()).select("url", *wanted, "label")
    sample = staged(
        bounded_sample(fitting, SAMPLE_ROWS, sum(by_class.values()), "url", *wanted), "url-sample"
    )
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxMemoryInMB=64, seed=1, cacheNodeIds=False,
        checkpointInterval=-1,
    ).fit(VectorAssembler(inputCols=wanted, outputCol="features").transform(sample))
    open_rows = trees.transform(vectors.filter(F.col("ruled").isNull()))
    score = vector_to_array("probability")[1]
    found = open_rows.select(
        "page_id", "host", "path", "rule",
        F.when(score >= 0.5, "block").otherwise("allow").alias("verdict"), score.alias("score"),
    )
    fixed = rows.filter(F.col("ruled").isNotNull()).select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"),
        F.lit(None).cast("double").alias("score"),
    )
    return fixed.unionByName(found)
