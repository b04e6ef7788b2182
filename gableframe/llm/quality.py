"""Quality of documents: a text classifier with hierarchical empirical Bayes priors.

A logistic regression reads a document's surface features. Its evidence, the log
odds it adds to the base rate it was trained with, is joined with what the site is
like: a host's rate of good documents is drawn towards the global rate, a path's
towards its host's, each as strongly as the spread between groups of that level
warrants (Beta priors fitted by moments), so a site with few documents keeps close
to the level above. A document does not count in its own prior.

Groups are summed with partial aggregates; a host with a third of all documents is
one row of sums. Documents are scored where they are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

FEATURES = ("symbols", "capitals", "varied", "word_length", "lines", "repeated")
_SYMBOLS = r"[#$%&*|!<>{}\[\]^~=_\\@+]"


@dataclass(frozen=True)
class Settings:
    """``train_rows``: labelled documents the classifier is fitted on, at most; the
    rest of the pipeline uses all documents. ``threshold``: posterior probability of
    being good from which a document stays. ``strongest``: a prior never weighs more
    than so many documents."""

    train_rows: int = 20_000
    threshold: float = 0.5
    strongest: float = 1000.0
    penalty: float = 1e-4


def with_features(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``__features``, six numbers between about 0 and 1: shares of symbols and
    capitals among the characters, different words (on a log scale), word length,
    different lines, words that repeat the word before them. All defined for null and
    empty texts. Words and lines are cut once, in a projection of their own."""
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = rows.withColumn("__words", F.array_remove(F.split(whole, r"\s+"), ""))
    cut = cut.withColumn("__lines", F.array_remove(F.split(whole, "\n"), ""))
    words, lines = F.col("__words"), F.col("__lines")
    n = F.greatest(F.length(whole), F.lit(1))
    count = F.greatest(F.size(words), F.lit(1))
    again = F.zip_with(words, F.slice(words, 2, count), lambda a, b: a == b)
    made = F.array(
        F.regexp_count(whole, F.lit(_SYMBOLS)) / n,
        F.regexp_count(whole, F.lit(r"\p{Lu}")) / n,
        F.log1p(F.size(F.array_distinct(words))) / F.log1p(count),
        F.least(n / count / 20.0, F.lit(1.0)),
        F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        F.size(F.filter(again, lambda same: same)) / count,
    )
    return cut.withColumn("__features", made).drop("__words", "__lines")


@dataclass(frozen=True)
class Classifier:
    weights: tuple[float, ...]
    intercept: float
    base: float  # log odds of good among the rows it was fitted on

    def evidence(self, features: Column) -> Column:
        """Log odds that the features add to the base rate."""
        total = F.lit(self.intercept - self.base)
        for i, weight in enumerate(self.weights):
            total = total + features[i] * weight
        return total


def fit(docs: DataFrame, labels: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "quality") -> Classifier:
    """Fitted on a sample by hash of the key. Labels other than 0 and 1 are left out,
    as are keys without a document. With fewer than two labels of either kind the
    classifier adds no evidence."""
    # the least hashes of the labels, so that texts of the sample alone are looked up
    picked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"))
    picked = materialize(picked.orderBy(F.xxhash64("__key"), "__key", "__label").limit(cfg.train_rows), "quality-labels")
    rows = docs.join(F.broadcast(picked), docs[key] == picked["__key"]).select(F.col(text).alias("text"), "__label")
    rows = with_features(rows).select(F.col("__features").alias("f"), "__label")
    rows = materialize(rows, "quality-train")
    seen = dict(rows.groupBy("__label").count().collect())
    good, bad = seen.get(1.0, 0), seen.get(0.0, 0)
    if min(good, bad) < 2:
        return Classifier((0.0,) * len(FEATURES), 0.0, 0.0)
    model = LogisticRegression(featuresCol="v", labelCol="__label", regParam=cfg.penalty, maxIter=200, tol=1e-9).fit(
        rows.select(array_to_vector("f").alias("v"), "__label")
    )
    return Classifier(tuple(map(float, model.coefficients)), float(model.intercept), math.log(good / bad))


def _strength(between: float, rate: float, cfg: Settings) -> float:
    """Documents a prior is worth, from the variance of true rates around it."""
    spread = rate * (1 - rate)
    if between <= 0 or spread <= 0:
        return cfg.strongest
    return float(np.clip(spread / between - 1, 1.0, cfg.strongest))


def score(docs: DataFrame, classifier: Classifier, cfg: Settings = Settings(), host: str = "source", path: str = "lang", text: str = "text") -> DataFrame:
    """All columns of the documents and ``__own`` (probability by the classifier at
    the global rate), ``__host`` and ``__path`` (rates of the sites without the
    document itself), ``__posterior`` and ``__kept``.

    Null hosts are one host, null paths one path of their host. Null and empty texts
    are scored by their features like others. Repeated rows are separate documents.
    Columns of these five names, ``__words``, ``__lines``, ``__features`` and those of
    the site's sums (``__h`` to ``__hs``) are refused, any others may stand there; an
    empty table gives an empty table.
    """
    made = {"__own", "__host", "__path", "__posterior", "__kept", "__words", "__lines", "__features", "__h", "__p", "__n", "__s", "__hn", "__hs"}
    if made & set(docs.columns):
        raise ValueError(f"These columns are made here: {sorted(made & set(docs.columns))}")
    base = F.lit(classifier.base)
    judged = with_features(docs, text).withColumn("__own", _probability(classifier.evidence(F.col("__features")) + base))
    judged = judged.drop("__features")
    own = F.col("__own")
    sums = judged.select(F.col(host).alias("h"), F.col(path).alias("p"), own.alias("own")).groupBy("h", "p").agg(
        F.count("*").alias("n"), F.sum("own").alias("s"), F.sum(F.col("own") * (1 - F.col("own"))).alias("noise")
    )
    paths = materialize(sums, "quality-paths")
    hosts = materialize(paths.groupBy("h").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("noise").alias("hnoise")), "quality-hosts")
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    rate = min(max(total["s"] / total["n"], 1e-6), 1 - 1e-6) if total["n"] else 0.5
    # spread of group rates around the level above, less what chance alone explains
    def between(df: DataFrame, n: str, s: str, centre: Column) -> float:
        r = F.col(s) / F.col(n)
        square = (F.col(n) * (r - centre) ** 2 - r * (1 - r)) / 1.0
        got = df.agg(F.sum(square).alias("v"), F.sum(n).alias("w")).first()
        return got["v"] / got["w"] if got["w"] else 0.0

    host_weight = _strength(between(hosts, "hn", "hs", F.lit(rate)), rate, cfg)
    both = paths.join(hosts, paths["h"].eqNullSafe(hosts["h"])).select(paths["h"], "p", "n", "s", "hn", "hs")
    shrunk = (F.col("hs") + host_weight * rate) / (F.col("hn") + host_weight)
    path_weight = _strength(between(both, "n", "s", shrunk), rate, cfg)
    sites = materialize(both.select(F.col("h").alias("__h"), F.col("p").alias("__p"), *(F.col(c).alias(f"__{c}") for c in ("n", "s", "hn", "hs"))), "quality-sites")
    scored = judged.join(sites, judged[host].eqNullSafe(sites["__h"]) & judged[path].eqNullSafe(sites["__p"]))
    host_rate = (F.col("__hs") - F.col("__own") + host_weight * rate) / (F.col("__hn") - 1 + host_weight)
    scored = scored.withColumn("__host", host_rate)
    path_rate = (F.col("__s") - F.col("__own") + path_weight * F.col("__host")) / (F.col("__n") - 1 + path_weight)
    prior = F.least(F.greatest(path_rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    scored = scored.withColumn("__path", prior)
    evidence = F.ln(F.col("__own") / (1 - F.col("__own"))) - base
    scored = scored.withColumn("__posterior", _probability(evidence + F.ln(F.col("__path") / (1 - F.col("__path")))))
    return scored.withColumn("__kept", F.col("__posterior") >= cfg.threshold).drop("__h", "__p", "__n", "__s", "__hn", "__hs")


def _probability(log_odds: Column) -> Column:
    bounded = F.least(F.greatest(log_odds, F.lit(-30.0)), F.lit(30.0))
    return 1 / (1 + F.exp(-bounded))


def keep_good(docs: DataFrame, labels: DataFrame, cfg: Settings = Settings(), **columns: str) -> DataFrame:
    """The rows of the documents that stay, with their own columns."""
    fitted = fit(docs, labels, cfg)
    return score(docs, fitted, cfg, **columns).where("__kept").select(*docs.columns)
