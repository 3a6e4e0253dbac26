"""URL filter: domain and path rules, and gradient-boosted trees on lexical features for the rest.

Only DataFrame functions and Spark's own tree learner run here. Rules name a host (with all its
subdomains) and a path prefix; of those that fit, the longest wins. URLs that a rule judges are the
labelled ones: the trees learn from a bounded sample of them (``TRAINING`` different URLs, half of them of
each verdict, chosen by a hash and weighted to the verdicts' natural rates) and judge the URLs that no rule
fits. Features: lengths, depth, digit ratio, character entropy, counts of parameters and marks, and
statistics of the suffix: how often labelled URLs with the same last host label, and with the same last
two, are blocked, smoothed. The statistics count all labelled rows.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; repeated
rows are judged alike; without labelled URLs of both kinds, everything that no rule fits is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.scratch import stored

TRAINING, TREES, DEPTH = 20_000, 20, 4
#: Verdict, host, path prefix.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "entropy", "parameters", "query_length",
    "hyphens", "longest_label", "has_fragment", "is_secure", "suffix_blocked", "domain_blocked")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character of the letters, digits and marks that URLs are made of."""
    n = F.greatest(F.length(text), F.lit(1))
    terms = []
    for char in "abcdefghijklmnopqrstuvwxyz0123456789-._/%":
        count = F.length(text) - F.length(F.replace(text, F.lit(char)))
        share = count / n
        terms.append(F.when(count > 0, -share * F.log2(share)).otherwise(0.0))
    return reduce(lambda a, b: a + b, terms)


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """All columns, host, path, and the features that need no statistics."""
    # one projection per step, so that an expression isn't repeated in those built on it
    host, path = parts(F.col(url))
    named = urls.withColumns({"host": host, "path": path, "_u": F.lower(F.coalesce(F.col(url), F.lit("")))})
    name, verdict = rule_columns(F.col("host"), F.col("path"))
    query = F.regexp_extract("_u", r"\?([^#]*)", 1)
    u, labels = F.col("_u"), F.split("host", r"\.")
    digits = F.length(u) - F.length(F.regexp_replace(u, "[0-9]", ""))
    return named.withColumns({
        "rule": name, "verdict": verdict, "url_length": F.length(u), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.length("path") - F.length(F.replace("path", F.lit("/"))), "host_labels": F.size(labels),
        "digit_ratio": digits / F.greatest(F.length(u), F.lit(1)), "entropy": entropy(u),
        "parameters": F.when(query != "", F.size(F.split(query, "&"))).otherwise(0), "query_length": F.length(query),
        "hyphens": F.length("host") - F.length(F.replace("host", F.lit("-"))), "longest_label": F.array_max(F.transform(labels, F.length)),
        "has_fragment": u.contains("#").cast("int"), "is_secure": u.startswith("https").cast("int"),
        "_suffix": F.substring_index("host", ".", -1), "_domain": F.substring_index("host", ".", -2)}).drop("_u")


def labelled_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """(url, y, _suffix, _domain, copies): each different URL that a rule judges, once."""
    known = lexical(pages.select(F.col(url).alias("url"))).where("verdict is not null")
    y = (F.col("verdict") == "block").cast("double").alias("y")
    return stored(known.groupBy("url", y, "_suffix", "_domain").agg(F.count("*").alias("copies")), "labelled")


def statistics(urls: DataFrame) -> dict[str, DataFrame]:
    """Per suffix and per domain: blocked rows ``s`` and rows ``n`` of all labelled URLs."""
    return {
        key: stored(urls.groupBy(key).agg(F.sum(F.col("y") * F.col("copies")).alias("s"), F.sum("copies").alias("n")), key.strip("_"))
        for key in ("_suffix", "_domain")}


def judged(pages: DataFrame, url: str = "url") -> DataFrame:
    """All columns of ``pages``, host, path, rule and verdict. ``pages`` must not have these four."""
    urls = labelled_urls(pages, url)
    sums = statistics(urls)
    kinds = {r.y: r for r in urls.groupBy("y").agg(F.sum("copies").alias("n"), F.count("*").alias("urls")).collect()}
    chosen = lexical(pages, url)
    if len(kinds) < 2:
        return chosen.select(*pages.columns, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    base = kinds[1.0].n / (kinds[0.0].n + kinds[1.0].n)
    half = TRAINING // 2
    picked = [urls.where(F.col("y") == y).orderBy(F.xxhash64("url"), "url").limit(half) for y in (0.0, 1.0)]
    weights = {y: max(1.0, r.urls / half) for y, r in kinds.items()}
    sample = picked[0].unionAll(picked[1]).select("url", "y", "copies", F.when(F.col("y") == 1, weights[1.0]).otherwise(weights[0.0]).alias("_weight"))
    sample = stored(lexical(sample, "url"), "urls")

    def with_statistics(df: DataFrame, own: bool) -> DataFrame:
        """Smoothed shares of blocked URLs; a training URL's own labels are left out of its statistics."""
        for key, out in (("_suffix", "suffix_blocked"), ("_domain", "domain_blocked")):
            s, m = F.coalesce("s", F.lit(0.0)), F.coalesce("n", F.lit(0))
            s, m = (s - F.col("y") * F.col("copies"), m - F.col("copies")) if own else (s, m)
            df = df.join(sums[key], key, "left").withColumn(out, (s + 5 * base) / (m + 5)).drop("s", "n")
        return df

    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    trees = GBTClassifier(labelCol="y", featuresCol="_features", maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="_weight", predictionCol="_predicted").setProbabilityCol("_chance").setRawPredictionCol("_raw")
    model = trees.fit(assemble.transform(with_statistics(sample, True)).select("_features", "y", "_weight"))
    scored = model.transform(assemble.transform(with_statistics(chosen, False)))
    guess = F.when(vector_to_array("_chance")[1] >= 0.5, "block").otherwise("allow")
    return scored.select(*pages.columns, "host", "path", "rule", F.coalesce("verdict", guess).alias("verdict"))


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    return judged(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
