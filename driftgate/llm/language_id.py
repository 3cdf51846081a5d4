"""Language identification by error-correcting output codes.

Each language has a codeword; each bit has a binary n-gram classifier that
tells the languages with a 1 from those with a 0, by the mean log ratio of the
smoothed frequencies of the text's byte n-grams on both sides.  Decoding is
loss-weighted: a bit's logistic loss against each codeword counts by how often
that bit was right for that language on training rows; the nearest codeword wins,
and a text whose two nearest codewords are close is flagged as ambiguous.

Up to ``EXHAUSTIVE`` languages take all distinct splits as bits; more take the
best of many seeded random codes.  N-gram counts cover every training row and
are summed on the cluster; only sums by language and n-gram cell reach the
driver.  Bits are calibrated on a bounded sample of ``calibration_docs`` rows.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
A-Z is lower-cased; with one learned language every other text gets it, with
none everything is ``und``; null ids cannot be learned from; repeated rows are
judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import ship
from driftgate.llm.words import mix

ORDERS = (1, 2, 3)
CELLS = 1 << 14  # of each order
MOST_LANGUAGES = 500
EXHAUSTIVE = 6
CALIBRATION_DOCS = 10_000
SMOOTH = 0.5
NEAR = 0.15  # two codewords this close in probability: ambiguous
CHUNK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True


def codewords(k: int) -> np.ndarray:
    """k distinct rows of bits, far from each other."""
    if k <= 1:
        return np.zeros((k, 1), np.int8)
    if k <= EXHAUSTIVE:  # every split of the languages once: the first one's bit is always 1
        rest = np.arange(2 ** (k - 1) - 1)
        return np.stack([np.ones(len(rest), np.int8), *(((rest >> i) & 1).astype(np.int8) for i in range(k - 1))])
    bits = int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    rng = np.random.default_rng(7)
    for _ in range(100):
        code = rng.integers(0, 2, (k, bits), dtype=np.int8)
        apart = (code[:, None] != code[None]).sum(axis=2) + bits * np.eye(k, dtype=int)
        if apart.min() > far and (code.min(axis=0) < code.max(axis=0)).all():
            best, far = code, apart.min()
    return best


def grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of texts: row range, n-gram cells, and the first cell of each text (cells lie text by text)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    sizes = np.asarray(pc.binary_length(column), np.int64)
    lo = 0
    while lo < len(column):
        hi, total = lo, 0
        while hi < len(column) and (hi == lo or total + sizes[hi] <= CHUNK):
            total += sizes[hi]
            hi += 1
        part = column.slice(lo, hi - lo)
        _, offsets, data = part.buffers()
        off = np.frombuffer(offsets, np.int64)[part.offset : part.offset + hi - lo + 1]
        raw = _FOLD[np.frombuffer(data, np.uint8)[off[0] : off[-1]]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        yield lo, hi, raw, off - off[0]
        lo = hi


def cells(raw: np.ndarray, order: int) -> np.ndarray:
    """Cell of the n-gram that starts at each byte (the last ones reach into the next text and are masked)."""
    v = raw.astype(np.uint64)
    key = v.copy()
    for j in range(1, order):
        key[: len(v) - j] = key[: len(v) - j] * np.uint64(256) + v[j:]
    if order == 1:
        return key.astype(np.int64)
    return (mix(key + np.uint64(order << 40)) & np.uint64(CELLS - 1)).astype(np.int64)


def inside(off: np.ndarray, n: int, order: int) -> np.ndarray:
    """Which bytes start an n-gram that stays in its text."""
    ok = np.ones(n, bool)
    for j in range(1, order):
        last = off[1:] - j
        ok[last[(last >= off[:-1]) & (last < n)]] = False
    return ok


def has_letter(column: pa.Array, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_ASCII_LETTER[raw], out=total[1:])
    out = total[off[1:]] > total[off[:-1]]
    for i in np.flatnonzero(~out & (off[1:] > off[:-1])):
        out[i] = any(c.isalpha() for c in column[int(i)].as_py() or "")
    return out


def count_grams(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts by language, order and cell over all rows (lang, text)."""
    at = {v: i for i, v in enumerate(languages)}
    width = CELLS * len(ORDERS)

    def run(batches):
        total = np.zeros(len(languages) * width, np.int64)
        for batch in batches:
            lang = np.array([at.get(v, -1) for v in batch.column(0).to_pylist()], np.int64)
            for lo, hi, raw, off in grams(batch.column(1)):
                row = np.repeat(lang[lo:hi], np.diff(off))
                for o, order in enumerate(ORDERS):
                    ok = inside(off, len(raw), order) & (row >= 0)
                    total += np.bincount(row[ok] * width + o * CELLS + cells(raw, order)[ok], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["cell", "n"])

    rows = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(languages) * width)
    counts[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return counts.reshape(len(languages), len(ORDERS), CELLS)


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        p = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=2, keepdims=True)
        one = self.code.astype(float)
        side = lambda b: np.tensordot((b / np.maximum(b.sum(axis=0), 1)).T, p, 1)
        #: log ratio by cell and bit
        self.ratio = np.log(side(one) / side(1 - one)).transpose(1, 2, 0).astype(np.float32) if len(languages) > 1 else None
        bits = self.code.shape[1]
        self.scale, self.shift = np.full(bits, 20.0), np.zeros(bits)
        self.weight = np.ones(self.code.shape)

    def margins(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean log ratio of each text for each bit."""
        out = np.zeros((len(off) - 1, self.code.shape[1]))
        for o, order in enumerate(ORDERS):
            ok = inside(off, len(raw), order)
            v = self.ratio[o][cells(raw, order)]
            v[~ok] = 0
            some = np.flatnonzero(np.diff(off))
            n = np.maximum(np.diff(off)[some] - order + 1, 1)
            if len(some):
                out[some] += np.add.reduceat(v, off[:-1][some], axis=0, dtype=np.float64) / n[:, None]
        return out / len(ORDERS)

    def decode(self, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, its probability, and whether another one is close."""
        f = margin * self.scale + self.shift
        sign = 2.0 * self.code - 1
        loss = (self.weight[None] * np.logaddexp(0, -sign[None] * f[:, None, :])).sum(axis=2)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        top = np.sort(p, axis=1)
        return best, top[:, -1], top[:, -1] - top[:, -2] < NEAR

    def calibrate(self, margin: np.ndarray, lang: np.ndarray) -> None:
        """Slope and offset of each bit by logistic regression, and each bit's accuracy on each language."""
        y = self.code[lang].astype(float)
        for b in range(self.code.shape[1]):
            m, t = margin[:, b], y[:, b]
            if t.min() == t.max():
                continue
            w = np.array([1.0 / (m.std() + 1e-9), 0.0])
            for _ in range(50):  # Newton steps, with a ridge that keeps separable bits finite
                p = 1 / (1 + np.exp(-np.clip(w[0] * m + w[1], -30, 30)))
                x = np.stack([m, np.ones(len(m))], axis=1)
                g = x.T @ (p - t) + 1e-3 * w
                h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-3])
                w = w - np.clip(np.linalg.solve(h, g), -50, 50)
            self.scale[b], self.shift[b] = w
        right = ((margin * self.scale + self.shift > 0) == (y > 0)).astype(float)
        seen = np.bincount(lang, minlength=len(self.languages))
        for i in range(len(self.languages)):
            if seen[i]:
                self.weight[i] = (right[lang == i].sum(axis=0) + 1) / (seen[i] + 2)
        self.weight *= self.code.shape[1] / self.weight.sum(axis=1, keepdims=True)


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", calibration_docs: int = CALIBRATION_DOCS) -> Model:
    """Learn from text and non-null language of the rows for which ``learn`` holds."""
    ship(docs.sparkSession)
    rows = docs.where(learn & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(id_col).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    model = Model(languages, count_grams(rows.select("lang", "text"), languages) if len(languages) > 1 else np.zeros((len(languages), len(ORDERS), CELLS)))
    if len(languages) > 1:
        every = max(1, sum(sizes.values()) // calibration_docs)
        at = {v: i for i, v in enumerate(languages)}

        def run(batches):
            for batch in batches:
                for lo, hi, raw, off in grams(batch.column(1)):
                    ok = np.flatnonzero(has_letter(batch.column(1).slice(lo, hi - lo), raw, off))
                    m = model.margins(raw, off)[ok]
                    who = [at[v] for v in batch.column(0).slice(lo, hi - lo).take(pa.array(ok)).to_pylist()]
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array([x.tobytes() for x in m], pa.binary())], ["lang", "m"])

        sample = rows.where(F.pmod("h", F.lit(every)) == 0).select("lang", "text").mapInArrow(run, "lang int, m binary").collect()
        if sample:
            model.calibrate(np.stack([np.frombuffer(r["m"]) for r in sample]), np.array([r["lang"] for r in sample]))
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, ambiguous."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    names = np.array([*model.languages, "und"], object)

    def run(batches):
        for batch in batches:
            for lo, hi, raw, off in grams(batch.column(1)):
                ok = has_letter(batch.column(1).slice(lo, hi - lo), raw, off)
                if len(names) > 2:
                    best, score, close = model.decode(model.margins(raw, off))
                else:
                    best, score, close = np.zeros(hi - lo, int), np.full(hi - lo, float(len(names) - 1)), np.zeros(hi - lo, bool)
                pick = names[np.where(ok, best, len(names) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(pick, pa.string()), pa.array(np.where(ok, score, 0.0), pa.float64()), pa.array(close & ok, pa.bool_())],
                    ["id", "lang_pred", "score", "ambiguous"],
                )

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
