"""Quality classifier with hierarchical empirical Bayes.

A logistic classifier on text statistics, fitted on a bounded sample of labelled rows, gives every
document a probability and so a likelihood ratio, its evidence. Sites are summed by grouped
aggregation: a host's rate of good documents is drawn towards the global rate, and the rate of a
path on it towards its host's, each by a strength that comes from how much the groups differ
(analysis of variance over all documents). A sparse site therefore stays near its prior. A
document's posterior joins its evidence with its path's rate, counted without the document itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, mark, separators, staged, text_chunks, without
from strata.llm.toxicity import logistic_fit

#: At most so many labelled rows of each class are used for the classifier.
SAMPLE = 6000
#: The strength of a prior, in documents, stays within these bounds.
STRENGTH = (1.0, 1e6)

_SPACED = separators((0x09, 0x0D), (0x20, 0x20))
_LINES = separators((0x0A, 0x0A), (0x0D, 0x0D))


def _byte_classes() -> np.ndarray:
    """0 lower-case, 1 upper-case, 2 digits, 3 non-ASCII, 4 white space and controls, then one per sign."""
    out = np.full(256, 4, dtype=np.int64)
    sign = 5
    for b in range(33, 127):
        c = chr(b)
        if c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        else:
            out[b] = sign
            sign += 1
    out[128:] = 3
    return out


_CLASSES = _byte_classes()
_SIGNS = int(_CLASSES.max()) + 1
N_FEATURES = _SIGNS + 5


def _distinct(words: Words) -> np.ndarray:
    """Distinct words per document."""
    doc = words.doc_of()
    order = np.lexsort((words.hashes, doc))
    d, h = doc[order], words.hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=len(words.first) - 1)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics of whole texts, one row each: shares of the kinds of characters, length and
    repetition of words and lines. An empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    counts = np.bincount(doc * _SIGNS + _CLASSES[data], minlength=n * _SIGNS).reshape(n, _SIGNS)
    words, lines = Words(data, offsets, _SPACED), Words(data, offsets, _LINES)
    n_words, n_lines = np.diff(words.first), np.diff(lines.first)
    out = np.zeros((n, N_FEATURES))
    out[:, :_SIGNS] = np.log1p(100 * counts / np.maximum(size, 1)[:, None])
    out[:, _SIGNS] = np.log1p(n_words)
    out[:, _SIGNS + 1] = np.log1p((size - counts[:, 4]) / np.maximum(n_words, 1))
    out[:, _SIGNS + 2] = _distinct(words) / np.maximum(n_words, 1)
    out[:, _SIGNS + 3] = _distinct(lines) / np.maximum(n_lines, 1)
    out[:, _SIGNS + 4] = np.log1p(n_lines / np.maximum(n_words, 1))
    return out


@dataclass
class Classifier:
    """weights over standardized features; base: the log odds of the labelled rows."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Of good against bad, bounded so that one odd text is not certain."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -12, 12)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column) -> Classifier:
    """From at most SAMPLE labelled rows of each class, spread by a hash of the id, that ``train`` admits.

    The constant is set for the shares of all admitted labels. Without rows of both classes the
    weights are zero, and the base is the smoothed share of good rows.
    """
    known = staged(labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & train)
                   .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("y")),
                   "quality-labels")
    total = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    good, bad = total.get(1, 0), total.get(0, 0)
    base = float(np.log((good + 0.5) / (bad + 0.5)))
    none = Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.append(np.zeros(N_FEATURES), base), base)
    if not good or not bad:
        return none
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.union(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column("text")):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([b.column("y").slice(row, end - row), pa.array(list(x))], names=["y", "x"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("y", "text").mapInArrow(run, "y int, x array<double>").toPandas()
    if rows["y"].nunique() < 2:
        return none
    x, y = np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-6] = 1
    weights = logistic_fit(np.clip((x - mean) / scale, -8, 8), y, penalty=1.0)
    weights[-1] += base - np.log(y.sum() / (len(y) - y.sum()))
    return Classifier(mean, scale, weights, base)


def evidence(docs: DataFrame, model: Classifier, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    """(id, host, path, evidence, p) per row: the log likelihood ratio and the classifier's probability."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column("text")):
                odds = m.log_odds(features(data, offsets))
                part = b.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("host"), part.column("path"), part.column("mark"),
                     pa.array(odds - m.base), pa.array(1 / (1 + np.exp(-odds)))],
                    names=["id", "host", "path", "mark", "evidence", "p"])

    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(host_col).cast("string").alias("host"),
                         F.col(path_col).cast("string").alias("path"), mark(text_col).alias("mark"), text.alias("text"))
    return source.mapInArrow(run, "id long, host string, path string, mark long, evidence double, p double")


def _strength(groups: DataFrame, mean: float) -> float:
    """How many documents a prior is worth, from the variance between groups beyond that within.

    groups: n, s (sum) and q (sum of squares) each.
    """
    r = groups.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.lit(mean), F.lit(2))).alias("between"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within")).first()
    if not r.n or r.k < 2 or r.n <= r.k:
        return STRENGTH[1]
    typical = (r.n - r.nn / r.n) / (r.k - 1)
    spread = (r.between / (r.k - 1) - max(r.within, 0.0) / (r.n - r.k)) / typical
    if spread <= 0:
        return STRENGTH[1]
    return float(np.clip(mean * (1 - mean) / spread - 1, *STRENGTH))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          path_col: str = "lang", label_col: str = "quality", least: float = 0.5, train: Column | None = None) -> DataFrame:
    """doc_id, host, path, evidence, host_rate, path_rate, posterior, keep and mark (a hash of the
    text), one row per row of ``docs``.

    A null or empty text has the statistics of nothing, and is judged like any other. Null hosts
    and paths form groups of their own. Labels with a null id or value are left out; of repeated
    labels of an id the lowest counts. ``train`` may hold labels back. Without labels of both
    classes the evidence is zero and the posterior is the labelled rate. A null id is kept, and
    repeated rows stay repeated. Other columns are not read. No documents give no rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col, F.lit(True) if train is None else train)
    rows = staged(evidence(docs, model, id_col, text_col, host_col, path_col), "quality-evidence")
    sums = [F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")]
    paths = staged(rows.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q")))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = min(max(total.s / total.n, 1e-4), 1 - 1e-4) if total.n else 0.5
    weak, strong = _strength(hosts, rate), _strength(paths, rate)
    host = hosts.select(F.col("host").alias("h"), ((F.lit(weak * rate) + F.col("s")) / (F.lit(weak) + F.col("n"))).alias("host_rate"))
    site = (paths.join(host, F.col("host").eqNullSafe(F.col("h")))
            .select(F.col("host").alias("h"), F.col("path").alias("pa"), "n", "s", "host_rate"))
    joined = rows.join(site, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("pa")))
    others = (F.lit(strong) * F.col("host_rate") + F.greatest(F.col("s") - F.col("p"), F.lit(0.0))) / (
        F.lit(strong) + F.col("n") - 1)
    bounded = F.least(F.greatest(others, F.lit(1e-4)), F.lit(1 - 1e-4))
    odds = F.col("evidence") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    return (joined.withColumn("path_rate", bounded).withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .select(F.col("id").alias("doc_id"), "host", "path", "evidence", "host_rate", "path_rate", "posterior",
                    (F.col("posterior") >= least).alias("keep"), "mark"))


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score`` keeps. A row is known by its id and text, so
    rows that share an id are judged one by one, and a row without an id by its text."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    return without(docs, score(docs, labels, **how).where(~F.col("keep")), id_col, text_col)
