"""Quality classifier (9): document evidence within hierarchical site priors.

A document's own evidence is a logistic model over its counts. Sites share
strength in two levels: a host's quality is a Beta posterior around the global
rate, a path's one around its host's. The weight of each prior comes from the
data: the less hosts differ from each other, the more a sparse host is drawn
to the global rate. Only sums per (host, path) are ever gathered.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only, stored, with_columns_aside
from postmill.llm.metrics import measured_texts
from postmill.operators.joins import fits_broadcast, lookup_join
from postmill.session import durable

#: At most so many labelled documents, those with the smallest hash of their id, fit the model.
MAX_TRAINING_DOCS = 20_000
#: Bounds of the prior weights, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0
#: One document's evidence and one site's shift count at most so much, in log-odds.
EVIDENCE_LIMIT, SITE_LIMIT = 12.0, 2.0


def _per(count: str, unit: str) -> Column:
    return F.when(F.col(unit) > 0, F.col(count) / F.col(unit)).otherwise(0.0)


def features() -> list[Column]:
    """Numbers between 0 and about 3 each."""
    return [
        F.least(_per("n_symbols", "n_words"), F.lit(3.0)),
        F.least(_per("n_exclamations", "n_words"), F.lit(3.0)),
        _per("n_capitals", "word_chars"),
        _per("n_dup_lines", "n_lines"),
        _per("n_repeat_words", "n_words"),
        _per("n_same_neighbours", "n_words"),
        F.least(_per("word_chars", "n_words") / 10, F.lit(3.0)),
        F.when(F.col("n_stop_words") > 0, 0.0).otherwise(1.0),
        F.least(F.log1p("n_words") / 10, F.lit(3.0)),
    ]


class Model(NamedTuple):
    """Weights of the features and the intercept, last."""

    weights: list[float]

    def evidence(self) -> Column:
        """Log-odds of good quality from a document's counts alone."""
        total = F.lit(self.weights[-1])
        for weight, feature in zip(self.weights, features(), strict=False):
            total = total + feature * weight
        return F.least(F.greatest(total, F.lit(-EVIDENCE_LIMIT)), F.lit(EVIDENCE_LIMIT))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = MAX_TRAINING_DOCS,
) -> Model:
    """Logistic regression on the counts of at most ``max_docs`` labelled documents.

    A document labelled twice counts as bad if one of its labels is 0; null labels
    and ids are left out. Without labels of both kinds every document gets the
    evidence of the one kind, or 0 when there are none. The driver sees
    ``max_docs`` rows of ten numbers.
    """
    known = only(labels, id_col, label_col).where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = (
        known.groupBy(id_col)
        .agg(F.min(label_col).cast("double").alias("_y"))
        .orderBy(F.xxhash64(F.col(id_col), F.lit(9)), id_col)
        .limit(max_docs)
    )
    texts = only(docs, id_col, text_col).join(F.broadcast(chosen), id_col)
    counted = measured_texts(texts, text_col, [id_col, "_y"])
    rows = counted.select(F.array(*(f.cast("double") for f in features())).alias("x"), "_y").toPandas()
    if rows.empty:
        return Model([0.0] * (len(features()) + 1))
    x = np.c_[np.array(rows["x"].tolist(), dtype=float), np.ones(len(rows))]
    return Model([float(weight) for weight in _logistic(x, rows["_y"].to_numpy(dtype=float))])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Newton's method; the ridge keeps separable data finite."""
    order = np.lexsort((*x.T, y))  # sums do not depend on the order rows came in
    x, y = x[order], y[order]
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty * weights)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _log_odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def _prior_weight(n: float, mean: float, between: float) -> float:
    """Method of moments for a Beta prior: how many documents the prior is worth."""
    if n < 2 or between <= 0 or not 0 < mean < 1:
        return MOST_WEIGHT
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, mean * (1 - mean) / between - 1))


def site_posteriors(scored: DataFrame, host: str, path: str, p: str) -> tuple[DataFrame, dict[str, float]]:
    """Sums per site and the prior weights: one row per (host, path) with the host's
    sums and its own. Null host or path are sites of their own.

    The spread between sites is measured beyond what sampling alone explains:
    the squared distance of a site's mean from its parent's less the sampling
    variance, weighted by the site's number of documents.
    """
    by_path = durable(
        scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("_np"), F.sum(F.round(p, 9).cast("decimal(20,9)")).cast("double").alias("_sp"))
    )
    by_host = by_path.groupBy(F.col(host).alias("_host")).agg(F.sum("_np").alias("_nh"), F.sum("_sp").alias("_sh"))
    sites = by_path.join(by_host, F.col(host).eqNullSafe(F.col("_host"))).drop("_host")
    total = by_path.agg(F.sum("_np").alias("n"), F.sum("_sp").alias("s")).first()
    n, mean = total["n"] or 0, (total["s"] or 0.0) / max(total["n"] or 0, 1)

    def spread(rows: DataFrame, mean_of: Column, size: str, parent: Column) -> float:
        sampling = parent * (1 - parent) / F.col(size)
        row = rows.agg(
            F.sum(F.col(size) * (F.pow(mean_of - parent, 2) - sampling)).alias("v"), F.sum(size).alias("w")
        ).first()
        return (row["v"] or 0.0) / max(row["w"] or 0, 1)

    between_hosts = spread(by_host, F.col("_sh") / F.col("_nh"), "_nh", F.lit(mean))
    between_paths = spread(sites, F.col("_sp") / F.col("_np"), "_np", F.col("_sh") / F.col("_nh"))
    priors = {
        "mean": mean,
        "host_weight": _prior_weight(n, mean, between_hosts),
        "path_weight": _prior_weight(n, mean, between_paths),
    }
    return sites, priors


def posterior(priors: dict[str, float], evidence: str, p: str) -> tuple[Column, Column]:
    """(site quality, posterior quality) of a document whose site's sums are beside it.

    The document's own share is taken out of its site's sums first, so its
    evidence is not used twice.
    """
    own = F.round(p, 9)
    mean = F.lit(priors["mean"])
    host = (F.col("_sh") - own + priors["host_weight"] * mean) / (F.col("_nh") - 1 + priors["host_weight"])
    site = (F.col("_sp") - own + priors["path_weight"] * host) / (F.col("_np") - 1 + priors["path_weight"])
    shift = F.least(F.greatest(_log_odds(site) - _log_odds(mean), F.lit(-SITE_LIMIT)), F.lit(SITE_LIMIT))
    return site, _probability(F.col(evidence) + shift)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: id, host, path, evidence, site_quality, score, kept.

    ``host`` and ``path`` are columns of ``docs``; by default its source and, within
    it, its language. Null and empty texts are scored from counts of 0. Repeated
    rows each count. An empty table gives an empty result; further columns are
    not looked at.
    """
    model = fit(docs, labels, id_col, text_col)
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    read = only(docs, *dict.fromkeys([id_col, text_col, *(c for c in ("source", "lang") if c in docs.columns)]))
    read = read.select(id_col, text_col, host.cast("string").alias("host"), path.cast("string").alias("path"))
    scored = durable(_scored(read, model, text_col, [id_col, "host", "path"]))
    sites, priors = site_posteriors(scored, "host", "path", "_p")
    site, score = posterior(priors, "evidence", "_p")
    joined = _beside(scored, sites, ["host", "path"], [id_col, "evidence"])
    return joined.select(
        id_col, "host", "path", "evidence", site.alias("site_quality"), score.alias("score"), (score >= threshold).alias("kept")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """The rows of ``docs`` whose posterior reaches the threshold, with all columns.

    Rows are scored once, without their texts; those that fail are then taken out
    by id and hash of the text. Texts are not shuffled unless the rejected rows
    are too many to broadcast. Rows equal in id, text and site fare alike.
    """
    model = fit(docs, labels, id_col, text_col)
    read = only(docs, *dict.fromkeys([id_col, text_col, host_col, path_col])).select(
        text_col,
        F.struct(F.col(id_col).alias("k"), F.col(host_col).cast("string").alias("h"), F.col(path_col).cast("string").alias("p")).alias("_k"),
        F.xxhash64(text_col).alias("_text_hash"),
        F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"),
    )
    scored = stored(_scored(read, model, text_col, ["_k", "_text_hash", "host", "path"]), "quality-scores")
    sites, priors = site_posteriors(scored, "host", "path", "_p")
    _, score = posterior(priors, "evidence", "_p")
    joined = _beside(scored, sites, ["host", "path"], ["_k", "_text_hash"])
    rejected = stored(joined.where(score < threshold).select("_k", "_text_hash").distinct(), "quality-rejected")
    aside, old, new = with_columns_aside(docs)
    site = [F.col(new[name]).cast("string").alias(short) for name, short in ((host_col, "h"), (path_col, "p"))]
    keyed = aside.select("*", F.struct(F.col(new[id_col]).alias("k"), *site).alias("_k"), F.xxhash64(new[text_col]).alias("_text_hash"))
    gone = F.broadcast(rejected) if fits_broadcast(rejected) else rejected
    return keyed.join(gone, ["_k", "_text_hash"], "left_anti").select(*aside.columns).toDF(*old)


def _scored(rows: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    counted = measured_texts(rows, text_col, keep).select(*keep, model.evidence().alias("evidence"))
    return counted.select("*", _probability(F.col("evidence")).alias("_p"))


def _beside(scored: DataFrame, sites: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Each document with its site's sums, over one key that is never null."""
    key = F.xxhash64(*keys, *(F.col(k).isNull() for k in keys))
    narrow = sites.select(key.alias("_site"), "_np", "_sp", "_nh", "_sh")
    return lookup_join(scored.withColumn("_site", key), narrow, "_site", spread_by, "inner").drop("_site")
