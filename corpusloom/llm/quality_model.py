"""Quality by hierarchical empirical Bayes: document evidence and site posteriors.

A logistic model, fitted on at most ``FIT_ROWS`` labelled documents, gives every
document a probability and, against the base rate, its log-likelihood ratio.
Sites have two levels, host and path.  Every document adds to both its label,
or its probability where it has none; sums are formed by grouped aggregation,
so a host with a third of all rows costs one row per task.  The strength with
which hosts shrink toward the global mean, and paths toward their host, is
estimated from the spread of their means beyond chance (method of moments for
the beta-binomial).  A document's own part is taken out of the sums before its
site speaks for it.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrays import Texts, slices
from corpusloom.llm.logit import fit
from corpusloom.llm.quality_rules import n_dup_lines, n_lines, n_repeat_words, n_words, word_chars
from corpusloom.llm.sampling import hashed_sample
from corpusloom.operators.lookup import lookup
from corpusloom.staging import stage

FIT_ROWS = 20_000
THRESHOLD = 0.5
#: Fixed part of a site row when sites are broadcast.
SITE_ROW = 96
_BYTES = np.arange(256)
_CLASSES = tuple(np.isin(_BYTES, np.frombuffer(chars, np.uint8)) for chars in (
    b"#*$%&<>", b"|", b"!?", b".,;:", b"\n", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123))))
WEIGHT = 1.0


def features(texts: Texts) -> np.ndarray:
    """A constant and rates of whole texts, ``(documents, features)``."""
    words = np.maximum(n_words(texts), 1)
    size = np.maximum(np.diff(texts.bounds), 1)
    per_word = [np.log1p(texts.sums(c[texts.data]) / words) for c in _CLASSES[:6]]
    upper, lower = (texts.sums(c[texts.data]) for c in _CLASSES[6:])
    columns = [
        np.ones(len(texts)), np.log1p(n_words(texts)) / 5, np.log1p(word_chars(texts) / words), *per_word,
        upper / np.maximum(upper + lower, 1), texts.sums(texts.data >= 128) / size,
        n_dup_lines(texts) / np.maximum(n_lines(texts), 1), n_repeat_words(texts) / words]
    return np.stack(columns, axis=1)


N_FEATURES = 13


def _features(batches):
    for batch, texts in slices(batches):
        f = features(texts)
        lists = pa.ListArray.from_arrays(np.arange(0, f.size + 1, f.shape[1], dtype=np.int32), f.ravel())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["doc_id", "host", "path", "x"])


def _labels(labels: DataFrame, label: str) -> DataFrame:
    """One label from 0 to 1 per document."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return rows.groupBy("doc_id").agg(F.avg(label).alias("y"))


def fit_evidence(rows: DataFrame, labels: DataFrame, n: int = FIT_ROWS) -> np.ndarray:
    """Weights of the document model from ``n`` labelled rows at most, spread by a hash of the id."""
    chosen = hashed_sample(labels, n, "doc_id", "y")
    sample = rows.select("doc_id", "x").join(F.broadcast(chosen), "doc_id").toPandas()
    sample = sample.sort_values("doc_id").drop_duplicates("doc_id")
    x = np.array(sample["x"].tolist(), float).reshape(len(sample), N_FEATURES)
    return fit(x, (sample["y"].to_numpy(float) >= 0.5).astype(float), np.zeros(N_FEATURES), np.full(N_FEATURES, WEIGHT / 10))


def strength(sites: DataFrame, mean) -> float:
    """How many documents a prior is worth, from the spread of site means about ``mean``.

    ``sites`` has ``n`` and ``s`` (documents and their sum).  Spread that chance
    explains gives a strong prior, at most 10,000 documents; the least is 1.
    """
    got = sites.select("n", (F.col("s") / F.col("n")).alias("m"), mean.alias("mu")).where("n > 1").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("mu"), 2)).alias("spread"),
        F.sum(F.col("mu") * (1 - F.col("mu"))).alias("chance"),
        F.sum((F.col("n") - 1) * F.col("mu") * (1 - F.col("mu"))).alias("room")).first()
    beyond = ((got.spread or 0) - (got.chance or 0)) / got.room if got.room else 0
    return float(np.clip(1 / beyond - 1, 1, 10_000)) if beyond > 1e-4 else 10_000.0


def quality_posterior(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality",
    threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``doc_id, evidence, site, score, kept`` of every row of ``docs``.

    ``docs`` has ``doc_id``, ``text`` and the columns named by ``host`` and
    ``path``; ``labels`` has ``doc_id`` and ``label`` (0 or 1).  ``evidence`` is
    the log-likelihood ratio of the document model, ``site`` the posterior mean
    of the document's path without the document itself, ``score`` the posterior
    that the document is good, ``kept`` whether it reaches ``threshold``.

    Null texts count as empty.  Null hosts and paths are sites of their own.
    Null labels and ids are not learned from; several labels of a document are
    averaged, rows without an id are scored.  Labels of ids that are not in
    ``docs`` are not used at all; without labels of documents there, all scores
    are one half and every document is kept.  Repeated rows each count.  Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    unknown = F.lit("\0")
    inputs = docs.select(
        "doc_id", F.coalesce(F.col(host).cast("string"), unknown).alias("host"),
        F.coalesce(F.col(path).cast("string"), unknown).alias("path"), "text")
    rows = stage(inputs.mapInArrow(_features, f"doc_id {kind}, host string, path string, x array<double>"), "features")
    # Base rate, weights and site means all come from the labels of documents that are there.
    matched = _labels(labels, label).join(rows.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "doc_id", "left_semi")
    known = stage(matched, "labels")
    weights = fit_evidence(rows, known, fit_rows)
    base = known.agg(F.avg("y")).first()[0]
    base = float(np.clip(0.5 if base is None else base, 0.001, 0.999))
    logit = F.aggregate(F.zip_with("x", F.lit(weights.tolist()).cast("array<double>"), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = rows.select("doc_id", "host", "path", F.least(F.lit(30.0), F.greatest(F.lit(-30.0), logit)).alias("z"))
    scored = scored.join(known, "doc_id", "left").withColumn("p", 1 / (1 + F.exp(-F.col("z"))))
    # Sums of rounded numbers are exact, so their order does not matter.
    scored = stage(scored.withColumn("y", F.round(F.coalesce("y", "p"), 6).cast("decimal(10,6)")), "scored")

    paths = stage(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("y").cast("double").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("s") / F.sum("n")).first()[0]
    mean = float(np.clip(0.5 if total is None else total, 0.001, 0.999))
    host_strength = strength(hosts, F.lit(mean))
    hosts = hosts.withColumn("mu", (F.col("s") + host_strength * mean) / (F.col("n") + host_strength))
    both = paths.join(hosts.select("host", F.col("n").alias("nh"), F.col("s").alias("sh"), "mu"), "host")
    path_strength = strength(both, F.col("mu"))
    sites = stage(both.drop("mu"), "sites")

    y = F.col("y").cast("double")
    host_mean = (F.col("sh") - y + host_strength * mean) / (F.col("nh") - 1 + host_strength)
    site = (F.col("s") - y + path_strength * host_mean) / (F.col("n") - 1 + path_strength)
    joined = lookup(scored, sites, ["host", "path"], SITE_ROW)
    evidence = F.col("z") - float(np.log(base / (1 - base)))
    site = F.least(F.lit(0.999), F.greatest(F.lit(0.001), site))
    score = 1 / (1 + F.exp(-(F.ln(site / (1 - site)) + evidence)))
    out = joined.select("doc_id", F.round(evidence, 6).alias("evidence"), F.round(site, 6).alias("site"), F.round(score, 6).alias("score"))
    return out.withColumn("kept", F.col("score") >= threshold)
