"""Quality of documents from their text and from the site they come from.

A naive Bayes classifier over word shapes gives each document evidence. Its probabilities are
added up per host (the source) and per path (language within the source); empirical Bayes
shrinks a path towards its host and a host towards the corpus, the less rows the more, with
strengths estimated from the spread between the groups. The posterior of the document's path,
without the document itself, replaces the classifier's prior.
"""

from __future__ import annotations

import math
import operator
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tradewharf.llm.base import Scratch

#: Labelled rows the classifier is fitted on; further ones are left out by a hash of their id.
TRAIN_ROWS = 20_000
#: Shapes are hashed into this many features, which bounds the model.
FEATURES = 1 << 16
#: Probabilities are added up in millionths, so that sums do not depend on their order.
MICRO = 1_000_000
#: Documents below this posterior are rejected.
LEAST = 0.5

_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 192 else 65 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c for c in range(256)
)
_models: dict[str, np.ndarray] = {}


def shapes(text: str | None) -> Counter:
    """How often each word shape occurs, and how often a word repeats the one before.

    Letters become a or A, digits 9; continuation bytes of other letters go."""
    words = (text or "").encode().split()
    if not words:
        return Counter()
    out = Counter((text or "").encode().translate(_SHAPE, bytes(range(128, 192))).split())
    out[b"=again"] = sum(map(operator.eq, words, words[1:]))
    return out


def _bucket(shape: bytes) -> int:
    return zlib.crc32(shape) % FEATURES


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = np.zeros((2, FEATURES))
        for text, label in zip(batch.column("text").to_pylist(), batch.column("quality").to_pylist()):
            found = shapes(text)
            n = sum(found.values())
            for s, k in found.items():
                # Each document has the same say, whatever its length; in millionths.
                totals[label, _bucket(s)] += round(MICRO * k / n)
        used = np.flatnonzero(totals.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(totals[0, used].astype(np.int64)), pa.array(totals[1, used].astype(np.int64))], names=["bucket", "bad", "good"]
        )


def _raw(text: str | None, weights: np.ndarray) -> float:
    found = shapes(text)
    n = sum(found.values())
    return sum(weights[_bucket(s)] * k for s, k in found.items()) / n if n else 0.0


def _scorer(broadcast, key: str):
    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _models:
            _models.clear()
            _models[key] = np.frombuffer(broadcast.value)
        for texts in batches:
            yield pd.Series([_raw(t, _models[key]) for t in texts], dtype=float)

    return score


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, quality of about ``most`` labelled documents, one label each.

    Documents with labels that differ, null labels and null ids are left out."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_tw_max"))
    known = known.where("quality = _tw_max").select("doc_id", F.col("quality").cast("int").alias("quality"))
    n = max(known.count(), 1)
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * most // n)
    return docs.select("doc_id", "text").join(known, "doc_id")


def fit(rows: DataFrame) -> np.ndarray:
    """Weights per feature: the log ratio of its share in good and in bad documents.

    The sums come as one row per used feature. Without rows of both classes, or of none, the
    evidence is zero everywhere."""
    sums = rows.select("text", "quality").mapInArrow(_count, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = np.full((2, FEATURES), 1e-3)
    for r in sums.collect():  # at most FEATURES rows
        counts[0, r["bucket"]] += r["bad"] / MICRO
        counts[1, r["bucket"]] += r["good"] / MICRO
    seen = (counts > 1e-3).any(0)
    logs = np.log(counts / counts.sum(1, keepdims=True))
    return np.where(seen, np.clip(logs[1] - logs[0], -4, 4), 0.0)


def calibrate(scored: DataFrame) -> tuple[float, float]:
    """Slope and intercept of a logistic regression of quality on raw scores, from a histogram
    of the scores in hundredths: at most 801 rows, whatever was scored."""
    bins = scored.groupBy(F.round(F.col("raw") * 100).cast("long").alias("x")).agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n")).orderBy("x").collect()
    x = np.array([r["x"] / 100 for r in bins])
    good, n = np.array([r["good"] for r in bins], float), np.array([r["n"] for r in bins], float)
    if not len(x) or good.sum() in (0, n.sum()):
        return 0.0, 0.0
    # A weak pull to a slope of 1 keeps separable data finite.
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (good - n * p) - 0.1 * (w - [1.0, 0.0])
        hess = design.T @ (design * (n * p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _strength(groups: DataFrame, mean: str) -> float:
    """Pseudo-rows of the prior: m (1 - m) over the spread between groups beyond chance, by
    moments; one row of sums is read."""
    row = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("p") / F.col("n") - F.col(mean), 2)).alias("between"),
        F.sum(F.col("n")).alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.col(mean) * (1 - F.col(mean))).alias("chance"),
    ).first()
    if not row["k"] or row["k"] < 2 or not row["n"]:
        return 1.0
    noise = row["chance"] / row["n"]
    spread = max(row["between"] / row["n"] - noise * row["k"] / row["n"], 1e-6)
    return float(min(max(noise / spread - 1, 1.0), 1e6))


def posteriors(scored: DataFrame, scratch: Scratch) -> tuple[DataFrame, float, float]:
    """(paths: lang, source, n, p, host_mean; the corpus's mean; the paths' strength).

    One grouped aggregate over the documents; hosts and the corpus are sums of paths."""
    paths = scratch.cut(scored.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), (F.sum("micro") / MICRO).alias("p")), "paths")
    hosts = paths.groupBy("source").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("p").alias("p")).first()
    corpus = min(max(whole["p"] / whole["n"], 1e-3), 1 - 1e-3) if whole["n"] else 0.5
    k = _strength(hosts.withColumn("m", F.lit(corpus)), "m")
    hosts = hosts.select(F.col("source").alias("_tw_host"), ((F.col("p") + k * corpus) / (F.col("n") + k)).alias("host_mean"))
    paths = scratch.cut(paths.join(hosts, paths.source.eqNullSafe(hosts._tw_host)).drop("_tw_host"), "sites")
    return paths, corpus, _strength(paths, "host_mean")


def classify(docs: DataFrame, labels: DataFrame, least: float = LEAST, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, lang, source, evidence (log odds of the text alone),
    host_posterior, path_posterior, probability, kept.

    A text without words has no evidence and follows its site. Null languages and sources are
    groups of their own. Repeated rows count one by one. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "site-quality")
    rows = scratch.cut(training_rows(docs, labels, train_rows), "training")
    weights = fit(rows)
    raw = _scorer(spark.sparkContext.broadcast(weights.tobytes()), uuid.uuid4().hex)
    slope, intercept = calibrate(rows.select("quality", raw("text").alias("raw")))
    prior = rows.agg(F.avg("quality")).first()[0]
    base = math.log(prior / (1 - prior)) if prior and 0 < prior < 1 else 0.0
    scored = docs.select("doc_id", "lang", "source", F.round(raw("text"), 6).alias("_tw_raw"))
    odds = F.lit(slope) * F.col("_tw_raw") + intercept
    scored = scored.withColumn("_tw_odds", odds).drop("_tw_raw")
    scored = scored.withColumn("micro", F.round(MICRO / (1 + F.exp(-F.col("_tw_odds")))).cast("long"))
    scored = scratch.cut(scored, "scored")
    paths, corpus, k = posteriors(scored, scratch)
    sites = paths.withColumnsRenamed({"source": "_tw_s", "lang": "_tw_l"})
    joined = scored.join(sites, scored.source.eqNullSafe(sites._tw_s) & scored.lang.eqNullSafe(sites._tw_l))
    # Without the document itself, which already speaks through its evidence.
    path = (F.col("p") - F.col("micro") / MICRO + k * F.col("host_mean")) / (F.col("n") - 1 + k)
    path = F.least(F.greatest(path, F.lit(1e-3)), F.lit(1 - 1e-3))
    evidence = F.col("_tw_odds") - base
    total = F.log(F.col("path_posterior") / (1 - F.col("path_posterior"))) + F.col("evidence")
    out = joined.withColumns({"path_posterior": path, "evidence": evidence}).withColumn("probability", 1 / (1 + F.exp(-total)))
    return out.select(
        "doc_id", "lang", "source", F.round("evidence", 6).alias("evidence"), F.round("host_mean", 6).alias("host_posterior"),
        F.round("path_posterior", 6).alias("path_posterior"), F.round("probability", 6).alias("probability"),
        (F.col("probability") >= least).alias("kept"),
    )
