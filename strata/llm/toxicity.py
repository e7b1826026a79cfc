"""Toxic spans by a linear-chain conditional random field.

Labels mark documents. From a bounded sample of labelled rows the operator learns which word
forms (whole words and word beginnings) occur in toxic documents more than chance allows, and
labels tokens: in a toxic document, a token with such a form is toxic. A chain with two states (clean,
toxic) is trained on these labelled tokens by maximum likelihood. Every text is then tagged by
forward-backward over all of its tokens: a run of tokens without a known form has one transfer
matrix, whose power has a closed form, so only known tokens and their neighbours are visited and
the marginals are exact. The marginals are aggregated to a document score, calibrated on the
sample, and tokens whose marginal is one half or more give the offending spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ALNUM, Words, _powers, mix, staged, text_chunks

#: At most so many labelled rows of each class are used for training.
SAMPLE = {1: 4000, 0: 12000}
#: At most so many word forms are kept, those with the most evidence.
FORMS = 8192
#: Bytes of word beginnings that count as forms, beside whole words.
PREFIXES = (3, 4, 5, 6, 7, 8, 9, 10)
#: Bounds between the classes of known forms, by the lower confidence bound of their toxic share.
_SHARES = (0.3, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98)
#: Tokens on either side of the middle of a training window.
_SIDE = 16
_TABLE = 1 << 20


def word_forms(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word positions, form hashes) of whole words, then of the beginnings of longer words."""
    yield np.arange(len(words.starts)), words.hashes
    up, down = _powers(len(words.data) + 1)
    total = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(words.data * up[:len(words.data)], out=total[1:], dtype=np.uint64)
    for size in PREFIXES:
        at = np.flatnonzero(words.ends - words.starts > size)
        s = words.starts[at]
        yield at, mix((total[s + size] - total[s]) * down[s] + np.uint64(size))


@dataclass
class Model:
    """forms: sorted hashes; codes: their class, 1 or more. Chain: start[s], step[s, t], emit[code, s]
    (log scores). weights: of the document score over ``summaries``."""
    forms: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int8))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    emit: np.ndarray = field(default_factory=lambda: np.zeros((len(_SHARES) + 2, 2)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(5))

    def __post_init__(self):
        self.maybe = np.zeros(_TABLE, dtype=bool)  # a first look, before the search among the forms
        self.maybe[(self.forms & np.uint64(_TABLE - 1)).astype(np.int64)] = True

    def token_codes(self, words: Words) -> np.ndarray:
        """Per word the highest class of its forms; 0 if none is known."""
        out = np.zeros(len(words.starts), dtype=np.int8)
        if not len(self.forms):
            return out
        for at, h in word_forms(words):
            k = np.flatnonzero(self.maybe[(h & np.uint64(_TABLE - 1)).astype(np.int64)])
            i = np.minimum(np.searchsorted(self.forms, h[k]), len(self.forms) - 1)
            hit = self.forms[i] == h[k]
            np.maximum.at(out, at[k[hit]], self.codes[i[hit]])
        return out


def marginals(model: Model, codes: list[np.ndarray], gaps: list[np.ndarray], tails: np.ndarray) -> list[np.ndarray]:
    """P(toxic) at the visited tokens of several sequences.

    codes[d]: classes of the visited tokens; gaps[d]: how many unknown tokens (class 0) lie before
    each; tails[d]: how many follow the last. All sequences step together.
    """
    n, longest = len(codes), max(map(len, codes), default=0)
    if not longest:
        return [np.zeros(0) for _ in codes]
    code, gap = np.zeros((n, longest), dtype=np.int64), np.zeros((n, longest))
    size = np.array([len(c) for c in codes])
    for d in range(n):
        code[d, :size[d]], gap[d, :size[d]] = codes[d], gaps[d]
    step, emit, start = np.exp(model.step), np.exp(model.emit), np.exp(model.start)
    quiet = step * emit[0][None, :]  # transfer of one unknown token: state before, state at it
    (l1, l2), v = _eigen(quiet)
    back = np.linalg.inv(v)
    first = np.outer(v[:, 0], back[0])
    second = np.outer(v[:, 1], back[1])

    def after(g: np.ndarray) -> np.ndarray:
        """quiet to the power g, up to a factor per sequence."""
        return first[None] + ((l2 / l1) ** g)[:, None, None] * second[None]

    ahead = np.zeros((n, longest, 2))
    now = np.zeros((n, 2))
    for t in range(longest):
        on = np.flatnonzero(size > t)
        g = gap[on, t]
        if t == 0:
            # the first token has the start scores; unknown ones before it follow from there
            begin = np.where(g[:, None] > 0, start * emit[0], 0)
            through = np.einsum("ni,nij->nj", begin, after(np.maximum(g - 1, 0)))
            prior = np.where(g[:, None] > 0, through @ step, start)
        else:
            prior = np.einsum("ni,nij->nj", now[on], after(g)) @ step
        x = prior * emit[code[on, t]]
        now[on] = x / x.sum(axis=1, keepdims=True)
        ahead[on, t] = now[on]
    behind = np.ones((n, longest, 2))
    rest = np.einsum("nij,j->ni", after(np.asarray(tails, dtype=float)), np.ones(2))
    out = np.zeros((n, longest))
    for t in reversed(range(longest)):
        on = np.flatnonzero(size > t)
        last = size[on] == t + 1
        if t + 1 < longest:
            nxt = on[~last]
            x = (emit[code[nxt, t + 1]] * behind[nxt, t + 1]) @ step.T
            behind[nxt, t] = np.einsum("nij,nj->ni", after(gap[nxt, t + 1]), x)
        behind[on[last], t] = rest[on[last]]
        behind[on, t] /= behind[on, t].sum(axis=1, keepdims=True)
        p = ahead[on, t] * behind[on, t]
        out[on, t] = p[:, 1] / p.sum(axis=1)
    return [out[d, :size[d]] for d in range(n)]


def _eigen(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eig(m)  # a positive 2 x 2 matrix: both values are real and differ
    order = np.argsort(-values.real)
    return values.real[order], vectors.real[:, order]


def _visited(codes: np.ndarray) -> np.ndarray:
    """Positions of known tokens and their neighbours. Farther from a known token a marginal only
    falls, so no other token can reach one half unless a neighbour does."""
    known = codes > 0
    near = known.copy()
    near[1:] |= known[:-1]
    near[:-1] |= known[1:]
    return np.flatnonzero(near)


def _tag(model: Model, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document (positions in it, marginals) of the visited tokens."""
    all_codes = model.token_codes(words)
    at, codes, gaps, tails = [], [], [], []
    for a, b in zip(words.first, words.first[1:]):
        c = all_codes[a:b]
        p = _visited(c) if c.any() else np.zeros(0, dtype=np.int64)
        at.append(p)
        codes.append(c[p])
        gaps.append(np.diff(p, prepend=-1) - 1)
        tails.append(len(c) - 1 - p[-1] if len(p) else 0)
    # Sequences of like length step together.
    order = np.argsort([len(p) for p in at], kind="stable")
    found: list[np.ndarray] = [np.zeros(0)] * len(at)
    for i in range(0, len(order), 512):
        part = order[i:i + 512]
        for d, m in zip(part, marginals(model, [codes[d] for d in part], [gaps[d] for d in part],
                                        np.array([tails[d] for d in part]))):
            found[d] = m
    return list(zip(at, found))


def summaries(tagged: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray) -> np.ndarray:
    """What the document score sees: the probability of any toxic token, the largest marginal, the
    log of the expected number, and the expected share."""
    out = np.zeros((len(tagged), 4))
    for d, (_, p) in enumerate(tagged):
        if len(p):
            out[d] = 1 - np.prod(1 - p), p.max(), np.log1p(p.sum()), p.sum() / sizes[d]
    return out


# --- training, on the bounded sample ---------------------------------------------------------------


def _chain_fit(codes: np.ndarray, tags: np.ndarray, classes: int, rounds: int = 150) -> tuple:
    """Maximum likelihood with a small penalty, by Adam over expected minus observed counts.

    codes, tags: windows x length; a code of -1 pads at the end. Equal windows (most have no known
    token at all) are visited once, with their number as weight.
    """
    n, length = codes.shape
    both_rows, times = np.unique(np.hstack([codes, tags]), axis=0, return_counts=True)
    codes, tags = both_rows[:, :length], both_rows[:, length:]
    times = times.astype(float)
    every = np.repeat(times[:, None], length, axis=1)  # a window's weight at each of its tokens
    real = codes >= 0
    size = real.sum(axis=1)
    c = np.maximum(codes, 0)
    theta = np.zeros(2 + 4 + classes * 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def split(x):
        return x[:2], x[2:6].reshape(2, 2), x[6:].reshape(classes, 2)

    seen = np.zeros_like(theta)
    s, a, e = split(seen)
    np.add.at(s, tags[:, 0], times)
    both = real[:, 1:]
    np.add.at(a, (tags[:, :-1][both], tags[:, 1:][both]), every[:, 1:][both])
    np.add.at(e, (c[real], tags[real]), every[real])
    for k in range(1, rounds + 1):
        start, step, emit = (np.exp(x) for x in split(theta))
        fwd, bwd, scale = np.zeros((len(c), length, 2)), np.ones((len(c), length, 2)), np.ones((len(c), length))
        for t in range(length):
            x = (start if t == 0 else fwd[:, t - 1] @ step) * emit[c[:, t]]
            scale[:, t] = x.sum(axis=1)
            fwd[:, t] = np.where(real[:, t, None], x / scale[:, t, None], fwd[:, t - 1])
        for t in reversed(range(length - 1)):
            x = (emit[c[:, t + 1]] * bwd[:, t + 1] / scale[:, t + 1, None]) @ step.T
            bwd[:, t] = np.where((size > t + 1)[:, None], x, 1)
        want = np.zeros_like(theta)
        ws, wa, we = split(want)
        p = fwd * bwd
        p *= (times[:, None] / p.sum(axis=2))[:, :, None]
        ws += p[:, 0].sum(axis=0)
        for state in (0, 1):
            we[:, state] += np.bincount(c[real], weights=p[:, :, state][real], minlength=classes)
        pair = fwd[:, :-1, :, None] * step * (emit[c[:, 1:]] * bwd[:, 1:] / scale[:, 1:, None])[:, :, None, :]
        wa += (pair[both] * every[:, 1:][both][:, None, None]).sum(axis=0)
        g = (seen - want) / n - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.2 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return split(theta)


def logistic_fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - penalty * w)
        w = w + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return w


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(y, text): at most SAMPLE rows of each class, spread by a hash of the id; none held out."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    chosen = None
    for y, most in SAMPLE.items():
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return staged(texts.join(F.broadcast(chosen), "id").select("y", "text"), "toxicity-sample")


def _count_forms(only: np.ndarray | None):
    """Per class, in how many documents a form occurs; ``only`` these forms, if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: []}
        for b in batches:
            y = b.column("y").to_numpy()
            for row, end, data, offsets in text_chunks(b.column("text")):
                words = Words(data, offsets, ALNUM)
                doc_of = words.doc_of()
                for at, h in word_forms(words):
                    d = doc_of[at]
                    if only is not None:
                        i = np.minimum(np.searchsorted(only, h), max(0, len(only) - 1))
                        ok = only[i] == h if len(only) else np.zeros(len(h), dtype=bool)
                        d, h = d[ok], h[ok]
                    order = np.lexsort((d, h))
                    d, h = d[order], h[order]
                    once = np.ones(len(h), dtype=bool)
                    once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    label = y[row:end][d[once]]
                    for k in (0, 1):
                        held[k].append(np.unique(h[once][label == k], return_counts=True))
        for k, parts in held.items():
            if parts:
                forms, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(forms))
                yield pa.RecordBatch.from_arrays([pa.array(forms.view(np.int64)), pa.array(np.full(len(forms), k)),
                                                  pa.array(n.astype(np.int64))], names=["form", "y", "n"])
    return run


def _form_counts(sample: DataFrame, only: np.ndarray | None, least: int):
    rows = (sample.mapInArrow(_count_forms(only), "form long, y long, n long")
            .groupBy("form", "y").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas())
    return rows["form"].to_numpy(dtype=np.int64).view(np.uint64), rows["n"].to_numpy(dtype=np.float64)


def _windows(model: Model):
    """Of each labelled document up to three windows of token classes: around known tokens, or in
    the middle; tokens with a known form are toxic if the document is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column("y").to_numpy()
            for row, end, data, offsets in text_chunks(b.column("text")):
                words = Words(data, offsets, ALNUM)
                codes = model.token_codes(words)
                out, labels = [], []
                for d, (a, z) in enumerate(zip(words.first, words.first[1:])):
                    c = codes[a:z]
                    known = np.flatnonzero(c)
                    middles = known[np.unique(np.linspace(0, len(known) - 1, 3).astype(int))] if len(known) else [len(c) // 2]
                    for m in middles if len(c) else ():
                        out.append(c[max(0, m - _SIDE):m + _SIDE + 1].astype(np.int8).tobytes())
                        labels.append(int(y[row + d]))
                yield pa.RecordBatch.from_arrays([pa.array(labels, type=pa.int64()), pa.array(out, type=pa.binary())],
                                                 names=["y", "codes"])
    return run


def _summary_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column("text")):
                words = Words(data, offsets, ALNUM)
                x = summaries(_tag(model, words), np.diff(words.first))
                yield pa.RecordBatch.from_arrays([b.column("y").slice(row, end - row), *(pa.array(x[:, i]) for i in range(4))],
                                                 names=["y", "a", "b", "c", "d"])
    return run


def _lower_bound(share: np.ndarray, n: np.ndarray, z: float = 1.0) -> np.ndarray:
    """The Wilson bound: few documents leave the share of toxic ones open."""
    centre = share + z * z / (2 * n)
    return (centre - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learns the forms, the chain and the score from at most SAMPLE labelled rows of each class.

    Without labelled rows every score is one half; with rows of one class only, or without known
    forms, it is the smoothed share of toxic rows.
    """
    sample = training_rows(docs, labels, id_col, text_col, label_col)
    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    model = Model()
    model.weights[-1] = np.log((toxic + 0.5) / (clean + 0.5))
    if not toxic or not clean:
        return model
    forms, in_toxic = _form_counts(sample.where("y = 1"), None, 3)
    order = np.argsort(forms)
    forms, in_toxic = forms[order], in_toxic[order]
    seen, times = _form_counts(sample.where("y = 0"), forms, 1)
    in_clean = np.zeros(len(forms))
    in_clean[np.searchsorted(forms, seen)] = times
    # A form is known if its documents are toxic more often than the sample's, by more than the
    # best of so many forms would be by chance (relative entropy against the log of their number).
    share, prior = in_toxic / np.maximum(in_toxic + in_clean, 1), toxic / (toxic + clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = share * np.log(share / prior) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - prior)), 0)
    evidence = (in_toxic + in_clean) * apart
    known = np.flatnonzero((share > max(prior, 0.3)) & (evidence > np.log(max(len(forms), 2))))
    known = np.sort(known[np.argsort(-evidence[known], kind="stable")][:FORMS])
    if not len(known):
        return model
    total = in_toxic[known] + in_clean[known]
    model = Model(forms[known], (1 + np.searchsorted(_SHARES, _lower_bound(share[known], total))).astype(np.int8))
    rows = sample.mapInArrow(_windows(model), "y long, codes binary").toPandas()
    length = 2 * _SIDE + 1
    codes = np.full((len(rows), length), -1, dtype=np.int64)
    for i, c in enumerate(rows["codes"]):
        codes[i, :len(c)] = np.frombuffer(c, dtype=np.int8)
    tags = ((codes > 0) & (rows["y"].to_numpy()[:, None] == 1)).astype(np.int64)
    model.start, model.step, model.emit = _chain_fit(codes, tags, len(_SHARES) + 2)
    x = sample.mapInArrow(_summary_rows(model), "y int, a double, b double, c double, d double").toPandas()
    model.weights = logistic_fit(x[["a", "b", "c", "d"]].to_numpy(), x["y"].to_numpy(dtype=float))
    return model


def tag(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans), one row per row of ``docs``; spans are (start, end, p): UTF-8 byte
    offsets of toxic tokens in the text, neighbours joined, and the largest marginal."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            for row, end, data, offsets in text_chunks(b.column(1)):
                words = Words(data, offsets, ALNUM)
                tagged = _tag(m, words)
                x = summaries(tagged, np.diff(words.first))
                score = 1 / (1 + np.exp(-np.clip(x @ m.weights[:4] + m.weights[4], -40, 40)))
                spans = []
                for d, (at, p) in enumerate(tagged):
                    own: list[dict] = []
                    before = -2
                    for i, q in zip(at[p >= 0.5].tolist(), p[p >= 0.5].tolist()):
                        w = words.first[d] + i
                        z = int(words.ends[w] - offsets[d])
                        if i == before + 1:
                            own[-1]["end"], own[-1]["p"] = z, max(own[-1]["p"], q)
                        else:
                            own.append({"start": int(words.starts[w] - offsets[d]), "end": z, "p": q})
                        before = i
                    spans.append(own)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, end - row), pa.array(score),
                                                  pa.array(spans, type=span)], names=["doc_id", "score", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double, spans array<struct<start:long,end:long,p:double>>")


def score_documents(docs: DataFrame, labels: DataFrame, least: float = 0.3, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted and spans, one row per row of ``docs``.

    Rows whose crc32(id as text) mod 4 is 2 are held out: their labels are never read. Labels with
    a null id or value are left out; of repeated labels of an id, the highest counts. A null text
    is empty; an empty text gets the score of a text without known forms and no spans. A null id is
    kept, not held out. Repeated rows stay repeated. Labels, language and source are no inputs of a
    score, and other columns are not read. No documents give no rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    return tag(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"),
        "spans")
