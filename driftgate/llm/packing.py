"""Bounded-space online packing of token ids into sequences.

Each task keeps ``open_windows`` open windows.  A document's ids are cut into
full windows, which leave at once, and a remainder.  A remainder goes into the
open window it fills best; if none has room, the fullest window leaves and a
new one opens.  What is open when a task ends is left over: the pieces of
leftovers are packed again, longest first, by the same rule, in groups of
tasks, until one group remains.  Every step holds ``open_windows`` windows per
task, and only leftovers meet other tasks' pieces.

``sequence_id`` names the task and number of its first piece, so it is unique
and grows with the place of that piece in the input; pieces of a sequence lie
gapless from offset 0.  With ``order`` the input is range-sorted by it first,
and leftovers are packed in that order instead of longest first: sequences then
follow the order, and so do the pieces in each.  The order of rows within a
task's input decides the packing, so a rerun of a task makes the same pieces.

Defined cases: null text is the empty text, whose ids are the end id alone;
repeated rows are packed each; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import ship, stash
from driftgate.llm.words import Texts, slices

KEPT_WORDS = 500_000
KEPT_SIGNS = 50_000
LATIN = "\u0130"  # below: letters that are their own composed form and lower-case one to one
SIGNS = ".,!?;:"
#: the sign that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from U+0100 on
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
FAN_IN = 64
_WINDOW_BITS = 32


class Encoder:
    """Ids of texts under a tokenizer that lower-cases, drops white space and never joins signs across it.

    Words recur, so the ids of each word are kept, by the word's 64-bit hash and
    length, in sorted arrays.  A new word of plain letters with signs at its end
    goes to the tokenizer's model directly, lower-cased and as the signs of its
    bytes; the tokenizer encodes every other word whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.signs: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(0, np.uint64)  # sorted
        self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.filled = np.zeros(1 << 16, np.int32), 0

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """Ids of each word: lower-cased letters go to the model itself, everything else through the whole tokenizer."""
        model, signs = self.tokenizer.model.tokenize, self.signs
        out, rest = [], []
        for w in words:
            core = w.rstrip(SIGNS)
            if core.isalpha() and (w.isascii() or max(w) < LATIN):
                low = core.lower()
                ids = [t.id for t in model(low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_SIGNS))]
                if len(core) < len(w):
                    tail = w[len(core) :]
                    if tail not in signs:
                        signs[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
                    ids += signs[tail]
                out.append(ids)
            else:
                rest.append(len(out))
                out.append([])
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            for at, e in zip(part, self.tokenizer.encode_batch([words[j] for j in part], add_special_tokens=False), strict=True):
                out[at] = e.ids
        if len(signs) > KEPT_SIGNS:
            signs.clear()
        return out

    def _learn(self, key: np.ndarray, words: list[str]) -> None:
        got = self._encoded(words)
        size = np.fromiter(map(len, got), np.int64, len(got))
        total = int(size.sum())
        while self.filled + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(got), np.int32, total)
        at = np.searchsorted(self.key, key)
        self.start = np.insert(self.start, at, (self.filled + np.cumsum(size) - size).astype(np.int32))
        self.size, self.key = np.insert(self.size, at, size.astype(np.int32)), np.insert(self.key, at, key)
        self.filled += total

    def batch(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.key) > KEPT_WORDS:
            self._forget()
        t = Texts(column)
        key = t.hash ^ (t.end - t.start).astype(np.uint64)
        words, first, number = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.key, words)
        new = np.ones(len(words), bool)
        old = at < len(self.key)
        new[old] = self.key[at[old]] != words[old]
        if new.any():
            data, f = t.raw.tobytes(), first[new]
            self._learn(words[new], [data[a:b].decode() for a, b in zip(t.start[f].tolist(), t.end[f].tolist(), strict=True)])
            at = np.searchsorted(self.key, words)
        at = at[number]
        start, size = self.start[at].astype(np.int64), self.size[at].astype(np.int64)
        end = np.cumsum(size)
        ids = self.flat[np.arange(end[-1]) + np.repeat(start - (end - size), size)] if len(end) else np.zeros(0, np.int32)
        last = np.concatenate([[0], end])[t.bounds]
        return [ids[a:b] for a, b in zip(last[:-1], last[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, so that tasks find the words of earlier ones."""
    return Encoder(path)


class Windows:
    """A fixed number of open windows; pieces are opaque and carry their length."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.room: list[int] = []
        self.held: list[list] = []

    def place(self, piece, length: int) -> list | None:
        """Place best-fit; returns the window that had to leave, if any."""
        best, gone = -1, None
        for i, r in enumerate(self.room):
            if r >= length and (best < 0 or r < self.room[best]):
                best = i
        if best < 0:
            if len(self.room) >= self.most:
                full = min(range(len(self.room)), key=self.room.__getitem__)
                gone = self.held.pop(full)
                self.room.pop(full)
            self.room.append(self.size)
            self.held.append([])
            best = len(self.room) - 1
        self.room[best] -= length
        self.held[best].append(piece)
        if self.room[best] == 0 and gone is None:
            self.room.pop(best)
            gone = self.held.pop(best)
        return gone


def _first_round(path: str, end_id: int, size: int, most: int, id_type: pa.DataType):
    def run(batches):
        encode, windows, task, number = encoder(path), Windows(size, most), TaskContext.get().partitionId(), 0  # of pieces, in reading order
        rows: list[tuple] = []
        values: list[np.ndarray] = []

        def leave(pieces, final: bool):
            offset = 0
            for doc, start, ids, total, piece in pieces:
                # a window is known by its first piece
                rows.append((doc, start, len(ids), total, task, pieces[0][-1], piece, offset, final))
                values.append(ids)
                offset += len(ids)

        def out():
            nonlocal rows, values
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
            kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
            flat = np.concatenate(values) if values else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            rows, values = [], []
            return pa.RecordBatch.from_arrays([*arrays, ids], ["id", "start", "length", "doc_tokens", "task", "window", "piece", "offset", "final", "ids"])

        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                for name, ids in zip(names, encode.batch(batch.column(1).slice(lo, hi - lo)), strict=True):
                    ids = np.append(ids, np.int32(end_id))
                    whole = len(ids) // size * size
                    for s in range(0, whole, size):
                        leave([(name, s, ids[s : s + size], len(ids), number)], True)
                        number += 1
                    if whole < len(ids):
                        gone = windows.place((name, whole, ids[whole:], len(ids), number), len(ids) - whole)
                        number += 1
                        if gone is not None:
                            leave(gone, True)
                if sum(map(len, values)) > 1_000_000:
                    yield out()
        for pieces in windows.held:
            leave(pieces, False)
        yield out()

    return run


def _merge_round(size: int, most: int, last: bool, in_order: bool):
    """Pack the leftover pieces of a group again, in their order or longest first."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        t = {c: np.asarray(table.column(c).combine_chunks()) for c in ("task", "window", "piece", "offset", "length")}
        place = (t["task"] << _WINDOW_BITS) + t["piece"]
        order = np.argsort(place) if in_order else np.lexsort((place, -t["length"]))
        windows, out = Windows(size, most), []

        def leave(pieces, final):
            offset, first = 0, min(int(place[i]) for i in pieces)
            for i in pieces:
                out.append((i, first, offset, final))
                offset += int(t["length"][i])

        for i in order.tolist():
            gone = windows.place(i, int(t["length"][i]))
            if gone is not None:
                leave(gone, True)
        for pieces in windows.held:
            leave(pieces, last)
        at, sequence, offset, final = (np.array(x, np.int64) for x in zip(*out, strict=True))
        return pa.table(
            {
                "task": t["task"][at],
                "window": t["window"][at],
                "piece": t["piece"][at],
                "offset": t["offset"][at],
                "length": t["length"][at],
                "group": pa.array(np.full(len(at), group // FAN_IN), pa.int64()),
                "new_sequence": pa.array(sequence, pa.int64()),
                "new_offset": pa.array(offset, pa.int64()),
                "done": pa.array(final.astype(bool), pa.bool_()),
            }
        )

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 2, open_windows: int = 64, order: Sequence[Column] = ()) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    The pieces with their ids are written once to the session's shared folder;
    the merge works on the lengths of leftovers alone.  ``order`` is the input's
    order, for sequence ids that grow with it.
    """
    spark = docs.sparkSession
    ship(spark)
    keys = [c.alias(f"order_{i}") for i, c in enumerate(order)]
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"), *keys)
    id_type = src.schema["id"].dataType.simpleString()
    if keys:
        names = [f"order_{i}" for i in range(len(keys))]
        src = src.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names)
    arrow_type = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    schema = f"id {id_type}, start long, length long, doc_tokens long, task long, window long, piece long, offset long, final boolean, ids array<int>"
    pieces, _ = stash(src.mapInArrow(_first_round(tokenizer, end_id, size, open_windows, arrow_type), schema))
    left = pieces.where(~F.col("final")).select("task", "window", "piece", "offset", "length", F.floor(F.col("task") / FAN_IN).cast("long").alias("group"))
    tasks = (pieces.where(~F.col("final")).agg(F.max("task")).first()[0] or 0) + 1
    rounds = max(1, math.ceil(math.log(tasks, FAN_IN) - 1e-9)) if tasks > 1 else 1
    made = None
    columns = "task long, window long, piece long, offset long, length long, group long, new_sequence long, new_offset long, done boolean"
    for r in range(1, rounds + 1):
        placed = left.groupBy("group").applyInArrow(_merge_round(size, open_windows, r == rounds, bool(keys)), columns)
        if r < rounds:
            placed, _ = stash(placed)
        part = placed.where("done").select("task", "window", "offset", "new_sequence", "new_offset")
        made = part if made is None else made.union(part)
        left = placed.where("not done").select("task", "window", "piece", "offset", "length", "group")
    fixed = pieces.where("final").withColumn("sequence_id", (F.col("task") * F.lit(1 << _WINDOW_BITS) + F.col("window")))
    moved = pieces.where("not final").join(made, ["task", "window", "offset"]).withColumn("sequence_id", F.col("new_sequence")).withColumn("offset", F.col("new_offset"))
    cols = [F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return fixed.select(*cols).union(moved.select(*cols))
