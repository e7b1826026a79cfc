"""Periodic runs: stretches of words that repeat with a period, and texts with one period of each kept.

A run is a maximal stretch of at least ``min_words`` words and ``times`` periods whose words a
period apart are equal, and no smaller period does. On the diagonal of its lag q (words i and i + q)
a run covers its length less q words, so for the lags of one class there is a least overlap that
every run reaches. Lags come in classes (k/2, k], the first being all lags up to k: there the overlap
is at least k, and all k-grams whose words recur soon enough are indexed. As k is not below the
lag, equal k-grams inside a run lie whole periods apart, so a run's lag is found between a gram's
neighbouring occurrences, and occurrences are enumerated as neighbours, never as all pairs. Each seed
is extended both ways word by word; what a lag has covered is remembered, so that the other seeds
of a diagonal are not extended again.

A document is worked on in the task that reads it: arrays of its words, about twelve vector passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.blanks import codes, spans
from strata.llm.common import mark, mix, text_chunks

MIN_WORDS, TIMES = 24, 3
RUN = "struct<start:long,length:long,period:long>"


def least_overlap(min_words: int, times: int) -> int:
    """The least number of words that a run has in common with itself one period on."""
    return min(max(min_words - q, (times - 1) * q) for q in range(1, min_words + 1))


def _reach(codes: np.ndarray, i: int, lag: int, stop: int, step: int) -> int:
    """The end of the equal words (i, i + lag), (i + step, ...), not beyond ``stop``."""
    size = 64
    while i != stop:
        n = min(size, abs(stop - i))
        a = i - n if step < 0 else i
        differ = np.flatnonzero(codes[a:a + n] != codes[a + lag:a + lag + n])
        if len(differ):
            return a + int(differ[-1]) + 1 if step < 0 else a + int(differ[0])
        i += step * n
        size *= 2
    return stop


def _all_near(gap: np.ndarray, k: int) -> np.ndarray:
    """Where ``k`` words in a row have gaps of ``k`` or less."""
    near = np.zeros(len(gap) + 1, dtype=np.int64)
    np.cumsum(gap <= k, out=near[1:])
    return near[k:] - near[:-k] == k if len(gap) >= k else np.zeros(0, dtype=bool)


def find_runs(codes: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, times: int = TIMES) -> np.ndarray:
    """(document, start, length, period) of all runs, by document, start and period; starts count from
    the document's first word. ``codes`` are the words of all documents as integers, equal codes
    for equal words, and document d has words first[d]:first[d + 1]."""
    if times < 3 or min_words < 2:
        raise ValueError("a run repeats three times or more and has two words or more")
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    same = (codes[order[1:]] == codes[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    here, again = order[:-1][same], order[1:][same]
    ahead, behind = np.full(n, n), np.full(n, n)  # words to the same word's next and last place
    ahead[here] = behind[again] = again - here
    grams, size = mix(codes.astype(np.uint64) + np.uint64(1)), 1
    k = 1 << (least_overlap(min_words, times).bit_length() - 1)
    longest = int(n_words.max(initial=0))
    found, least_lag = [], 1
    while least_lag * times <= longest and longest >= min_words:
        while size < k:  # hashes of 2, 4, ... k words
            grams = mix(grams[:-size] * np.uint64(0xA24BAED4963EE407) + grams[size:]) if len(grams) > size else grams[:0]
            size *= 2
        # Of a gram that comes again, or came before, k words off or less, every word does.
        at = np.flatnonzero(_all_near(ahead, k) | _all_near(behind, k))
        at = at[at + k <= first[doc[at] + 1]]
        if len(at):
            g = grams[at]
            order = np.argsort(g, kind="stable")
            a, b = at[order[:-1]], at[order[1:]]
            lag = b - a
            seed = (g[order[1:]] == g[order[:-1]]) & (doc[a] == doc[b]) & (lag >= least_lag) & (lag <= k)
            found += _extend(codes, first, doc, a[seed], lag[seed], k, min_words, times)
        least_lag, k = k + 1, k * 2
    runs = np.array(sorted(found), dtype=np.int64).reshape(-1, 4)
    runs[:, 1] -= first[runs[:, 0]]
    return runs


def _extend(codes, first, doc, at, lags, k: int, min_words: int, times: int) -> list[tuple]:
    """Runs of the seeds: grams of ``k`` words at ``at``, equal ``lags`` words on."""
    order = np.lexsort((at, lags))
    at, lags = at[order], lags[order]
    head = np.ones(len(at), dtype=bool)  # neighbours on a diagonal are one seed
    head[1:] = (lags[1:] != lags[:-1]) | (at[1:] != at[:-1] + 1)
    covered: dict[int, int] = {}  # by lag: how far its diagonal is known
    out = []
    for i, lag in zip(at[head].tolist(), lags[head].tolist()):
        if i < covered.get(lag, 0):
            continue
        d = int(doc[i])
        start = _reach(codes, i, lag, int(first[d]), -1)
        end = _reach(codes, i, lag, int(first[d + 1]) - lag, 1)
        covered[lag] = end
        if end - start + lag >= max(min_words, times * lag) and end - start >= k:
            out.append((d, start, end - start + lag, lag))
    return out


def collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, runs: np.ndarray) -> tuple:
    """(bytes, sums): the words that no run holds after its first period, joined by single spaces in each
    document; sums[i] of these bytes come from the first i bytes of ``data``."""
    n = len(starts)
    edge = np.zeros(n + 1, dtype=np.int64)
    base = first[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, base + runs[:, 3], 1)
    np.add.at(edge, base + runs[:, 2], -1)
    kept = np.cumsum(edge[:-1]) == 0
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, starts[kept], 1)
    np.add.at(inside, ends[kept], -1)
    use = np.cumsum(inside[:-1], dtype=np.int8) > 0
    # The blank after every kept word but the last of its document.
    at = np.flatnonzero(kept)
    owner = np.searchsorted(first, at, "right") - 1
    blank = ends[at[:-1]][owner[1:] == owner[:-1]]
    out = np.where(use, data, np.uint8(32))
    use[blank] = True
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(use, out=sums[1:])
    return out[use], sums


def _run_batches(min_words: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("text")):
                starts, ends, first = spans(data, offsets)
                runs = find_runs(codes(data, starts, ends)[0], first, min_words, times)
                text, sums = collapsed(data, starts, ends, first, runs)
                of_doc = np.searchsorted(runs[:, 0], np.arange(end - row + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(of_doc), pa.StructArray.from_arrays(
                    [pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"]))
                texts = pa.LargeStringArray.from_buffers(
                    end - row, pa.py_buffer(np.ascontiguousarray(sums[offsets])), pa.py_buffer(text)).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), batch.column("mark").slice(row, end - row),
                     pa.array(np.diff(first)), lists, texts],
                    ["doc_id", "mark", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS, times: int = TIMES) -> DataFrame:
    """doc_id, mark, n_words, runs (start, length, period; by start, then period) and collapsed, one row per row.

    Words are runs of characters other than blanks and the ASCII controls from tab to carriage return,
    compared as they are, and numbered from 0. ``collapsed`` holds the words that no run holds after
    its first period, joined by one space. A null text has no words, no runs and an empty collapsed
    text; so has an empty or blank one. Rows with a null id or a repeated id are worked on like any
    other, and ``mark``, a hash of the text, tells them apart. Other columns are not read. No rows
    give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), mark(text_col).alias("mark"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_run_batches(min_words, times),
                           f"doc_id long, mark long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period (ties: the first of them), or null."""
    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    return F.when(F.size(runs) > 0, F.aggregate(runs, F.element_at(runs, 1), better))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic end in every text whose id has a CRC-32 that ten divides.

    With g = crc32 // 10 and n words, words from a = g % n on repeat words a to a + p - 1, where
    p = 1 + (n - a) // (3 + g % 8). Other texts, and those of null ids, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)
    w = F.array_remove(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), "")
    n = F.size(w)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice(w, 1, a), F.slice(again, 1, n - a)), " ")
    return docs.withColumn(text_col, F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col(text_col)))


def digests(found: DataFrame) -> DataFrame:
    """One row per row of ``periodic_runs``: its strongest run, and digests of all runs and of the kept words."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
