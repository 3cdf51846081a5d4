"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line with a word is labelled good or bad.  A line's features are shares
of symbols, capitals, repeated words and the like, of itself and of the lines
before and after it; the chain adds the change from one line's label to the
next one's.  A document's quality is the mean over its lines of the marginal
probability of "good" (forward-backward), weighted by the lines' words, and
then calibrated on the training documents.

Labels exist for documents only.  Training starts with every line bearing its
document's label; lines of bad documents that the field then finds surely good
(clean lines around the bad ones) are relabelled and the field is fitted again.
Training uses at most ``train_docs`` labelled documents, the first in hash
order, of at most ``train_lines`` lines each; scoring covers whole texts.

Defined cases: a text without words (also null) is one empty line and scored
like any other; a null id cannot carry a label and is scored; a label is the
largest one a document has, null labels count as none; without any training
row, or with rows of one label, every score is that label's smoothed share (0.5
without rows); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import ship
from driftgate.llm.words import Texts, slices

TRAIN_DOCS = 8_000
TRAIN_LINES = 400
ROUNDS = 2
STEPS = 250
RIDGE = 1e-3
SURELY_GOOD = 0.8

_UPPER = np.zeros(256, np.int8)
_UPPER[65:91] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_LETTER[0xC3:0xD0] = 1  # first byte of a two-byte letter
_DIGIT = np.zeros(256, np.int8)
_DIGIT[48:58] = 1
_MARK = np.zeros(256, np.int8)
_MARK[[ord(c) for c in "#*$%&|<>~^_=+{}[]\\/@"]] = 1


def _is(char: str) -> np.ndarray:
    t = np.zeros(256, np.int8)
    t[ord(char)] = 1
    return t


_BYTES = {"mark": _MARK, "upper": _UPPER, "letter": _LETTER, "digit": _DIGIT, "bang": _is("!"), "bar": _is("|"), "stop": _is("."), "comma": _is(",")}


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines of all texts, each line's words, and the first line of each text."""
    t = Texts(column, "lower")
    start, end, row = t.lines()
    first, last = np.searchsorted(t.start, start), np.searchsorted(t.start, end)
    keep = last > first
    empty = np.flatnonzero(np.bincount(row[keep], minlength=t.n) == 0)
    start, end, row, first, last = (x[keep] for x in (start, end, row, first, last))
    words = (last - first).astype(np.float64)
    size = np.maximum(end - start, 1).astype(np.float64)

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[end] - total[start]) / size

    def word_share(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[last] - total[first]) / words

    got = {k: share(table[t.raw]) for k, table in _BYTES.items()}
    # capitals of two-byte letters: second byte 0x80-0x9E after 0xC3
    wide = np.zeros(len(t.raw), np.int8)
    wide[1:] = (t.raw[:-1] == 0xC3) & (t.raw[1:] >= 0x80) & (t.raw[1:] <= 0x9E)
    line_of = np.repeat(np.arange(len(row)), (last - first))
    n_in = last - first
    at = np.arange(n_in.sum()) - np.repeat(np.cumsum(n_in) - n_in, n_in) + np.repeat(first, n_in)
    h = t.hash[at]
    same = np.zeros(len(t.hash), np.int8)
    same[1:] = (t.hash[1:] == t.hash[:-1]) & (t.doc[1:] == t.doc[:-1])
    order = np.lexsort((h, line_of))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][new], minlength=len(row)) / words
    length = t.end - t.start
    bare = np.zeros(len(t.hash), np.int8)
    bare[:] = length == 1
    total_len = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=total_len[1:])
    mean_len = (total_len[last] - total_len[first]) / words
    close = np.isin(t.raw[t.end[last - 1] - 1], [ord("."), ord("?")]).astype(np.float64) if len(row) else words
    n_lines = np.bincount(row, minlength=t.n)
    own = np.stack(
        [
            got["mark"],
            np.sqrt(got["mark"]),
            (got["upper"] + share(wide)) / np.maximum(got["letter"], 0.02),
            got["digit"],
            got["bang"],
            np.sqrt(got["bang"]),
            got["bar"],
            got["stop"],
            got["comma"],
            word_share(same),
            np.sqrt(word_share(same)),
            distinct,
            word_share(bare),
            np.minimum(mean_len, 40.0) / 10,
            np.log1p(words),
            close,
            np.log1p(n_lines[row]),
        ],
        axis=1,
    )
    here = np.zeros(len(row))
    if len(empty):  # one line without words
        own = np.concatenate([own, np.zeros((len(empty), own.shape[1]))])
        row, words = np.concatenate([row, empty]), np.concatenate([words, np.ones(len(empty))])
        here = np.concatenate([here, np.ones(len(empty))])
        order = np.argsort(row, kind="stable")
        own, row, words, here = own[order], row[order], words[order], here[order]
    before, after = np.zeros_like(own), np.zeros_like(own)
    linked = row[1:] == row[:-1]
    before[1:][linked] = own[:-1][linked]
    after[:-1][linked] = own[1:][linked]
    has = np.zeros((len(row), 2))
    has[1:, 0] = linked
    has[:-1, 1] = linked
    x = np.concatenate([own, before, after, has, here[:, None]], axis=1)
    return x, words, np.searchsorted(row, np.arange(t.n + 1))


def forward_backward(score: np.ndarray, cut: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected label changes (2 x 2), and the sum of the chains' log partition.

    ``score`` is good's score of each line over bad's; ``change[a, b]`` the
    score of label b after label a.  Chains advance together, longest first.
    """
    size = np.diff(cut)
    order = np.argsort(-size, kind="stable")
    begin, size = cut[:-1][order], size[order]
    n, longest = len(size), int(size[0]) if len(size) else 0
    active = [int(np.searchsorted(-size, -step, "left")) for step in range(longest)]  # chains longer than step
    alpha = np.zeros((len(score), 2))
    for step in range(longest):
        k = active[step]
        at = begin[:k] + step
        emit = np.stack([np.zeros(k), score[at]], axis=1)
        if step:
            v = alpha[at - 1]
            alpha[at] = emit + np.logaddexp(v[:, :1] + change[0], v[:, 1:] + change[1])
        else:
            alpha[at] = emit
    beta = np.zeros((len(score), 2))
    log_z = np.logaddexp(*alpha[begin + size - 1].T) if n else np.zeros(0)
    pairs = np.zeros((2, 2))
    for step in range(longest - 2, -1, -1):
        k = active[step + 1]
        at = begin[:k] + step
        nxt = beta[at + 1] + np.stack([np.zeros(k), score[at + 1]], axis=1)
        both = change[None] + nxt[:, None, :]
        beta[at] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        pairs += np.exp(alpha[at][:, :, None] + both - log_z[:k, None, None]).sum(axis=0)
    joint = alpha + beta
    return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -500, 500))), pairs, float(log_z.sum())


def _doc_mean(p: np.ndarray, words: np.ndarray, cut: np.ndarray) -> np.ndarray:
    if len(cut) < 2:
        return np.zeros(0)
    return np.add.reduceat(p * words, cut[:-1]) / np.add.reduceat(words, cut[:-1])


def _adam(grad, w: np.ndarray, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return w


def fit(x: np.ndarray, words: np.ndarray, cut: np.ndarray, good: np.ndarray) -> dict:
    """Weights of the field and its calibration, from the training documents' lines and labels."""
    if len(good) == 0 or good.all() or not good.any():
        return {"share": (float(good.sum()) + 1) / (len(good) + 2)}
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    size = np.diff(cut)
    y = np.repeat(good, size).astype(np.float64)
    inside = np.ones(len(x), bool)
    inside[cut[:-1]] = False
    k = z.shape[1]
    w = np.zeros(k + 4)
    for _ in range(ROUNDS):
        i = np.flatnonzero(inside)
        seen = np.bincount((y[i - 1] * 2 + y[i]).astype(int), minlength=4).reshape(2, 2)

        def grad(w):
            p, pairs, _ = forward_backward(z @ w[:k], cut, w[k:].reshape(2, 2))
            g = np.concatenate([z.T @ (p - y), (pairs - seen).ravel()]) / len(y)
            return g + RIDGE * w

        w = _adam(grad, w, STEPS, 0.05)
        p, _, _ = forward_backward(z @ w[:k], cut, w[k:].reshape(2, 2))
        of_bad = np.repeat(~good.astype(bool), size)
        sure = of_bad & (p > SURELY_GOOD)
        left = np.repeat(np.add.reduceat((of_bad & ~sure).astype(np.int64), cut[:-1]) > 0, size)
        y = np.where(sure & left, 1.0, np.repeat(good, size))
    score = _doc_mean(p, words, cut)
    q = np.stack([_logit(score), np.ones(len(score))], axis=1)
    cal = _adam(lambda c: q.T @ (1 / (1 + np.exp(-np.clip(q @ c, -50, 50))) - good) / len(good) + 1e-4 * c, np.array([1.0, 0.0]), 500, 0.05)
    return {"mean": mean, "scale": scale, "w": w[:k], "change": w[k:].reshape(2, 2), "calibration": cal}


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def quality(model: dict, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Score of each text and the P(good) of its lines."""
    x, words, cut = line_features(column)
    if "share" in model:
        p = np.full(len(x), model["share"])
        return np.full(len(column), model["share"]), np.split(p, cut[1:-1])
    z = np.concatenate([(x - model["mean"]) / model["scale"], np.ones((len(x), 1))], axis=1)
    p, _, _ = forward_backward(z @ model["w"], cut, model["change"])
    a, b = model["calibration"]
    return 1 / (1 + np.exp(-np.clip(a * _logit(_doc_mean(p, words, cut)) + b, -50, 50))), np.split(p, cut[1:-1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> dict:
    """Fit on at most ``train_docs`` labelled documents for which ``learn`` holds (a bounded sample, on the driver)."""
    ship(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & learn).groupBy(F.col(id_col).alias("id")).agg(F.max("quality").alias("good"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(train_docs)

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                x, words, cut = line_features(batch.column(2).slice(lo, hi - lo))
                for i, (name, good) in enumerate(zip(batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_pylist(), strict=True)):
                    a, b = cut[i], cut[i + 1]
                    if b - a <= train_lines:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name], pa.int64()), pa.array([int(good > 0)], pa.int32()), pa.array([x[a:b].astype("<f4").tobytes()], pa.binary()), pa.array([words[a:b].tobytes()], pa.binary())],
                            ["id", "good", "x", "words"],
                        )

    # the sample is at most train_docs pairs of numbers: small whatever the tables hold
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "id")
    rows = picked.select("id", "good", "text").dropDuplicates(["id"]).mapInArrow(run, "id long, good int, x binary, words binary").collect()
    rows.sort(key=lambda r: r["id"])
    if not rows:
        return fit(np.zeros((0, 1)), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))
    words = [np.frombuffer(r["words"]) for r in rows]
    x = np.concatenate([np.frombuffer(r["x"], "<f4").reshape(len(w), -1) for r, w in zip(rows, words, strict=True)]).astype(np.float64)
    cut = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return fit(x, np.concatenate(words), cut, np.array([r["good"] for r in rows], np.float64))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, score and the P(good) of each line."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                s, lines = quality(model, batch.column(1).slice(lo, hi - lo))
                flat = np.concatenate(lines) if lines else np.zeros(0)
                cut = pa.array(np.concatenate([[0], np.cumsum([len(v) for v in lines], dtype=np.int64)]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(s, pa.float64()), pa.ListArray.from_arrays(cut, pa.array(flat, pa.float64()))], ["id", "score", "lines"])

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double, lines array<double>")
    return out.withColumnRenamed("id", id_col)


def keep(docs: DataFrame, model: dict, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, with a score of ``least`` or more."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            for lo, hi in slices(texts):
                s, _ = quality(model, texts.slice(lo, hi - lo))
                yield batch.slice(lo, hi - lo).filter(pa.array(s >= least))

    return docs.mapInArrow(run, docs.schema)
