"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic classifier on character and repetition statistics gives each document a
probability of being good. Its evidence is then pooled: hosts are Beta-binomial groups around
the global mean, paths are groups around their host's posterior, with the strength of both
priors estimated from the spread between groups. Sparse sites thus stay near the mean above
them. A document's final odds are its own odds times the odds, against the global mean, of the
posterior that its path has from all *other* documents, so no document's evidence counts twice.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled documents (those with the smallest
hash of their id). Everything else, the group statistics included, covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.caches import using
from loanloom.llm.storage import Scratch

TRAIN_ROWS = 20_000
RIDGE = 0.1
KEEP = 0.5
BROADCAST_SITES = 100_000
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6

FEATURES = ("symbols", "bars", "shouts", "capitals", "digits", "lines", "repeated_lines", "repeated_words", "stutter", "size", "word_length",
            "stops", "foreign")
_SYMBOLS = np.frombuffer(b"#$%&*", dtype=np.uint8)


def features(text: str | None) -> list[float]:
    """Shares of characters, repetition and size of a text; all zero for a text without characters."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, words, lines = len(raw), raw.split(), [x for x in raw.split(b"\n") if x]
    many = max(1, len(words))
    return [float(x) for x in (
        seen[_SYMBOLS].sum() / n, seen[ord("|")] / n, seen[ord("!")] / n, seen[65:91].sum() / n, seen[48:58].sum() / n, (seen[10] + 1) / n,
        1 - len(set(lines)) / max(1, len(lines)), 1 - len(set(words)) / many, sum(map(bytes.__eq__, words, words[1:])) / many,
        np.log1p(len(words)), n / many, seen[ord(".")] / n, seen[128:].sum() / n)]


_EXTRA = "__quality"
_VECTOR = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column of its texts' features."""
    at = docs.columns.index("text")
    names = [*docs.columns, _EXTRA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using()
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(at)]).reshape(-1, len(FEATURES))
            mine = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(FEATURES))], names=list(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, mine], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(_EXTRA, _VECTOR)]))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a ridge logistic regression, by Newton's method. One class only, or no
    rows: zero weights and the smoothed share as offset."""
    if len(np.unique(y >= 0.5)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(len(FEATURES)), float(np.log(share / (1 - share)))
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + RIDGE * np.eye(len(w)), z.T @ (y - p) - RIDGE * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / spread
    return weights, float(w[-1] - weights @ mean)


def train(described: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on the labelled documents with the smallest id hashes; repeated labels count as their mean."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("good"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = described.select("doc_id", f"{_EXTRA}.*").join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return fit(np.array([[r[f] for f in FEATURES] for r in sample]).reshape(-1, len(FEATURES)), np.array([r.good for r in sample]))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def evidence(model: tuple[np.ndarray, float]) -> Column:
    """The classifier's probability, from the feature struct."""
    weights, offset = model
    return _sigmoid(sum((F.lit(float(w)) * F.col(f"{_EXTRA}.{f}") for w, f in zip(weights, FEATURES)), F.lit(offset)))


def _strength(groups: DataFrame, centre: Column) -> float:
    """Prior strength of groups (good, n) around a centre by the method of moments: the spread of their
    rates beyond sampling noise. One row reaches the driver."""
    noise = centre * (1 - centre)
    rate = F.col("good") / F.col("n")
    row = groups.agg(
        F.sum(F.col("n") * (rate - centre) ** 2).alias("spread"), F.sum(noise).alias("expected"),
        F.sum(F.col("n") * noise).alias("noise"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups")).first()
    if not row.groups or not row.noise:
        return MAX_STRENGTH
    # E[spread] = noise per group + between-group variance times the rows
    between = max(0.0, (row.spread - row.expected) / row.n)
    average = row.noise / row.n
    return float(min(MAX_STRENGTH, max(MIN_STRENGTH, average / between - 1))) if between else MAX_STRENGTH


def site_posteriors(scored: DataFrame, scratch: Scratch) -> DataFrame:
    """Per (host, path): n, host_posterior, path_posterior, prior, and what they are made of (sums and
    numbers of both groups, strengths of both priors); from rows (host, path, p)."""
    paths = scratch.store(scored.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count(F.lit(1)).alias("n")))
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    prior = F.lit(float((total.good or 0) + 1) / ((total.n or 0) + 2))
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    strength = F.lit(_strength(hosts, prior))
    hosts = hosts.select(
        "host", F.col("good").alias("host_good"), F.col("n").alias("host_n"), strength.alias("host_strength"),
        ((strength * prior + F.col("good")) / (strength + F.col("n"))).alias("host_posterior"))
    paths = paths.join(hosts, "host")
    strength = F.lit(_strength(paths, F.col("host_posterior")))
    return scratch.store(paths.select(
        "host", "path", "n", "good", "host_n", "host_good", "host_posterior", "host_strength", strength.alias("path_strength"),
        ((strength * F.col("host_posterior") + F.col("good")) / (strength + F.col("n"))).alias("path_posterior"), prior.alias("prior")))


def posterior_of_others(site: Column, p: Column) -> Column:
    """The path's posterior without one of its documents, of evidence p; a document alone in its host has the prior."""
    def rest(strength: str, centre: Column, good: str, n: str) -> Column:
        # a sum may miss its last document by rounding
        others = F.greatest(F.lit(0.0), F.least(site[good] - p, site[n] - 1.0))
        return (site[strength] * centre + others) / (site[strength] + site[n] - 1)

    return rest("path_strength", rest("host_strength", site["prior"], "host_good", "host_n"), "good", "n")


def _site(host: Column, path: Column) -> list[Column]:
    return [F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")]


def judge(docs: DataFrame, labels: DataFrame, scratch: Scratch, host: str = "source", path: str = "lang") -> DataFrame:
    """``docs`` (doc_id, text, the host and path columns, any others) with a struct ``__verdict`` of
    classifier, host_posterior, path_posterior, quality and keep.

    A missing host or path is the site "". Empty and null texts are judged by their (zero)
    features. Other columns pass through, whatever their names; a column ``__verdict`` is replaced.
    Rows without a doc_id are judged like others and are in no training row. Without labels of both classes the classifier is their smoothed share, so
    nothing is rejected unless most labels are bad.
    """
    described = with_features(docs.select("doc_id", "text", *dict.fromkeys((host, path)))).drop("text")
    described = scratch.store(described)
    model = train(described, labels)
    sites = site_posteriors(described.select(*_site(F.col(host), F.col(path)), evidence(model).alias("p")), scratch)
    # the document's columns stay in one struct, so that no name of theirs meets one of ours
    sites = sites.select(F.struct("host", "path").alias("site"), F.struct(*[c for c in sites.columns if c not in ("host", "path")]).alias("post"))
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    docs = docs.drop("__verdict")
    own = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                      F.struct(*_site(F.col(host), F.col(path))).alias("site"))
    both = with_features(own).join(sites, "site")
    p, site = evidence(model), F.col("post")
    quality = F.round(_sigmoid(_logit(p) + _logit(posterior_of_others(site, p)) - _logit(site["prior"])), 6)
    verdict = F.struct(
        F.round(p, 6).alias("classifier"), F.round(site["host_posterior"], 6).alias("host_posterior"),
        F.round(site["path_posterior"], 6).alias("path_posterior"), quality.alias("quality"), (quality >= KEEP).alias("keep"))
    return both.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns], verdict.alias("__verdict"))
