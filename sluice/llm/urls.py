"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Rules name a host (with all its subdomains) and a path prefix; the longest that fits decides. The URLs that rules decide
are the labelled ones: trees are fitted on at most ``most`` of them (the least by a hash of their id) and judge all
other URLs by length, depth, digit ratio, character entropy, parameter counts and statistics of the host's suffix among
all labelled URLs (for the URLs that trees are fitted on: among those of the other ``FOLDS`` - 1 folds, so that no label
goes into its own feature). The fitted trees become one SQL expression, so judging is a projection of the scan without any
Python; suffix statistics of at most ``most`` rows are broadcast, more are joined by salted suffixes.

Null URLs and those without ``://`` have an empty host and path and no rule. Where the labelled URLs are not of both
kinds, the rest is allowed. Repeated rows are judged each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "marks", "suffix_share", "suffix_blocked")
_SALTS, FOLDS = 16, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  #: allow or block

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith(f".{self.host}")) & F.col("path").startswith(self.path)


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages with host and path."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return pages.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", F.regexp_extract(tail, r"^[^?#]*", 0))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _suffix() -> Column:
    return F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0).alias("suffix")


def lexical(rows: DataFrame, url: str = "url") -> DataFrame:
    """rows with the lexical features that need no statistics, and the host's suffix (its last two labels)."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    low = F.translate(u, _UPPER, _LOWER)
    part = lambda c: (F.length(low) - F.length(F.replace(low, c, F.lit("")))) / n
    chars = F.filter(F.array_distinct(F.split(low, "")), lambda c: c != "")
    entropy = F.aggregate(F.transform(chars, part), F.lit(0.0), lambda s, p: s - p * F.log2(p))
    return rows.select(
        "*",
        F.length(u).cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        _count(F.col("path"), "/").cast("double").alias("depth"),
        _count(F.col("host"), r"\.").cast("double").alias("labels"),
        (_count(u, "[0-9]") / n).alias("digits"),
        entropy.alias("entropy"),
        _count(u, "[?&]").cast("double").alias("parameters"),
        _count(u, "[-_=%#]").cast("double").alias("marks"),
        _suffix(),
    )


def _tree_sql(node) -> str:
    """A fitted tree's node as SQL."""
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    return f"CASE WHEN {FEATURES[split.featureIndex()]} <= {split.threshold()!r}D THEN {_tree_sql(node.leftChild())} ELSE {_tree_sql(node.rightChild())} END"


def _with_suffixes(rows: DataFrame, suffixes: DataFrame, id_col: str, many: bool) -> DataFrame:
    if many:
        salted = suffixes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64(id_col, "url"), F.lit(_SALTS)).cast("int")).join(salted.hint("merge"), ["suffix", "salt"], "left").drop("salt")
    else:
        joined = rows.join(F.broadcast(suffixes), "suffix", "left")
    return joined.withColumn("suffix_share", F.coalesce("suffix_share", F.lit(0.0))).withColumn("suffix_blocked", F.coalesce("suffix_blocked", F.lit(0.5)))


def trained(labelled: DataFrame, id_col: str, *, most: int, trees: int, depth: int, seed: int) -> tuple[str, DataFrame, bool] | None:
    """The trees' sum (over 0: block) as SQL over FEATURES, the suffix statistics, and whether these are over ``most``;
    None without both kinds of labels."""
    sample = labelled.orderBy(F.xxhash64(id_col), id_col).limit(most)
    sample = stored(lexical(sample).select(id_col, "url", *FEATURES[:-2], "suffix", (F.col("verdict") == "block").cast("double").alias("label")), "urls")
    n, blocked = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or not 0 < blocked < n:
        return None
    fold = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(FOLDS)).cast("int").alias("fold")
    by_fold = stored(labelled.select(_suffix(), fold, (F.col("verdict") == "block").cast("double").alias("label")).groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("blocked")), "suffix_folds")
    counts = stored(by_fold.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")), "suffixes")
    total, different = counts.agg(F.sum("n"), F.count("*")).first()
    suffixes = counts.select("suffix", (F.log1p(F.col("n").cast("double")) / F.log1p(F.lit(float(total)))).alias("suffix_share"), ((F.col("blocked") + 1) / (F.col("n") + 2)).alias("suffix_blocked"))
    many = different > most
    own = by_fold.join(counts.select("suffix", F.col("n").alias("all_n"), F.col("blocked").alias("all_blocked")), "suffix")
    own = own.select("suffix", "fold", ((F.col("all_blocked") - F.col("blocked") + 1) / (F.col("all_n") - F.col("n") + 2)).alias("suffix_blocked"))
    rows = _with_suffixes(sample, suffixes, id_col, many).drop("suffix_blocked").withColumn("fold", fold).join(own, ["suffix", "fold"])
    model = fitted(rows, trees=trees, depth=depth, seed=seed)
    return score_sql(model), suffixes, many


def fitted(rows: DataFrame, *, trees: int, depth: int, seed: int):
    """The trees of rows (FEATURES, label)."""
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=32).fit(table.select("features", "label"))


def score_sql(model) -> str:
    """The weighted sum of a model's trees, over 0 for its class 1, as SQL over FEATURES."""
    return " + ".join(f"{w!r}D * {_tree_sql(t._java_obj.rootNode())}" for t, w in zip(model.trees, model.treeWeights, strict=True))


def judge(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url: str = "url", most: int = 4000, trees: int = 8, depth: int = 4, seed: int = 7) -> DataFrame:
    """(id, host, path, rule, verdict) for each row of pages (id, url)."""
    rows = parsed(pages.select(id_col, F.col(url).alias("url")))
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(by_length):
        name = F.when(r.fits(), r.text).otherwise(name)
        verdict = F.when(r.fits(), r.verdict).otherwise(verdict)
    rows = rows.withColumn("rule", name).withColumn("verdict", verdict)
    method = trained(rows.where(F.col("rule").isNotNull()), id_col, most=most, trees=trees, depth=depth, seed=seed)
    if method is None:
        return rows.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    score, suffixes, many = method
    scored = _with_suffixes(lexical(rows), suffixes, id_col, many).withColumn("score", F.expr(score))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
