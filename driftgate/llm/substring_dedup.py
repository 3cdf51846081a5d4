"""Substring dedup by relative Lempel-Ziv parsing against an index of reference blocks.

The corpus is cut into reference blocks (documents by a hash of id and text).
Every block contributes its windows of ``window`` words to an index sharded by
content, where each window has its first place: the smallest document id, then
the smallest offset.  A document is then factored against that index: a factor
goes on as long as the first places of its windows are consecutive in one
earlier document, and where it ends, the windows that cross the boundary are
looked up like any other, so a passage is found even if no single source holds
all of it.  Neighbouring factors of different sources may thus share words, and
a factor is the longest of its own source, not of all documents: the index
keeps one source for each window, which bounds it by the number of windows.  The
words of factors (each at least ``window`` long) are duplicate spans.

Shuffle volume is held down in two steps.  Any two equal windows share their
minimiser, the smallest hash of their runs of ``SEED`` words; blocks first
exchange the distinct minimisers only (about two for nine words) and learn by
one bit for each whether another document has it.  Only windows with a shared
minimiser are sent on, once per block, with their first place there; what
returns are runs with a smaller document elsewhere.  A passage that a third of
all documents share is therefore one entry per block, never one per document.
Blocks recompute their entries in a fixed order, so the bits need no keys.

Defined cases: null text has no words; rows with a null id are neither
reference nor cut; rows that repeat an id are one document (they never cut each
other, and different texts of one id are dealt over the blocks); texts shorter than a window stay whole; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import ship
from driftgate.llm.words import Texts, covered, mix, run_hash

WINDOW = 13
SEED = 6  # with SPAN runs of SEED words in a window of 13
SPAN = 8
BLOCK_DOCS = 512
BLOCKS_PER_SHARD = 12

FACTORS = "array<struct<start: long, length: long, ref_doc: long, ref_start: long>>"


class Block:
    """The rows of one reference block in a fixed order, with their windows and minimisers."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").combine_chunks()
        text = table.column("text").combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids, text = pa.concat_arrays(ids.chunks), pa.concat_arrays(text.chunks)
        order = pc.sort_indices(pa.table({"id": ids, "text": text}), sort_keys=[("id", "ascending"), ("text", "ascending")])
        self.ids, self.text = ids.take(order), text.take(order)
        self.extra = table.column("extra").combine_chunks().take(order) if "extra" in table.column_names else None
        self.known = np.asarray(pc.is_valid(self.ids))
        self.doc_id = np.asarray(pc.fill_null(self.ids, 0), np.int64)
        self.t = Texts(self.text)
        at, h = self.t.windows(WINDOW)
        row = self.t.doc[at]
        use = self.known[row]
        self.at, self.h, self.row = at[use], h[use], row[use]
        low = run_hash(self.t.hash, SEED)
        step = 1
        while step < SPAN:  # sliding minimum over SPAN runs
            low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
            step *= 2
        self.seed = mix(low[self.at] ^ np.uint64(0x51ED)) if len(self.at) else self.h

    def seeds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct minimisers, sorted; which occur in two or more documents here; each window's index among them."""
        order = np.lexsort((self.doc_id[self.row], self.seed))
        s, d = self.seed[order], self.doc_id[self.row][order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        group = np.cumsum(new) - 1
        other = np.zeros(len(s), bool)
        other[1:] = ~new[1:] & (d[1:] != d[:-1])
        several = np.bincount(group, other, minlength=int(new.sum())) > 0
        back = np.empty(len(s), np.int64)
        back[order] = group
        return s[new], several, back


def _shard(seed: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a minimiser; grows with its value, so that sorted minimisers fall into runs."""
    return ((seed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _array(scalar) -> np.ndarray:
    return np.frombuffer(scalar.as_py(), np.uint64)


def _seed_rows(shards: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        s, several, _ = Block(table).seeds()
        cut = np.searchsorted(_shard(s, shards), np.arange(shards + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.table(
            {
                "shard": pa.array(full, pa.int32()),
                "block": pa.array(np.full(len(full), key[0].as_py()), pa.int64()),
                "seeds": pa.array([s[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary()),
                "several": pa.array([_bits(several[cut[i] : cut[i + 1]]) for i in full], pa.binary()),
            }
        )

    return run


def _shared_seeds(table: pa.Table) -> pa.Table:
    """For each block of a shard, one bit per minimiser: found in another document."""
    parts = [_array(x) for x in table.column("seeds")]
    sizes = np.array([len(p) for p in parts])
    several = np.concatenate([_flags(x.as_py(), n) for x, n in zip(table.column("several"), sizes, strict=True)])
    _, back, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = (times[back] > 1) | (np.bincount(back, several) > 0)[back]
    cut = np.concatenate([[0], np.cumsum(sizes)])
    bits = [shared[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    some = np.array([x.any() for x in bits])
    return pa.table(
        {
            "shard": table.column("shard").filter(pa.array(some)),
            "block": table.column("block").filter(pa.array(some)),
            "bits": pa.array([_bits(x) for x, ok in zip(bits, some, strict=True) if ok], pa.binary()),
        }
    )


def _window_rows(shards: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, bits: pa.Table) -> pa.Table:
        b = Block(docs)
        s, _, back = b.seeds()
        cut = np.searchsorted(_shard(s, shards), np.arange(shards + 1))
        shared = np.zeros(len(s), bool)
        for i, x in zip(bits.column("shard").to_pylist(), bits.column("bits"), strict=True):
            shared[cut[i] : cut[i + 1]] = _flags(x.as_py(), cut[i + 1] - cut[i])
        cand = np.flatnonzero(shared[back]) if len(back) else back
        _, first = np.unique(b.h[cand], return_index=True)  # rows are in id order: the first is the smallest
        cand = cand[np.sort(first)]
        shard = _shard(b.seed[cand], shards)
        order = np.argsort(shard, kind="stable")
        cand, shard = cand[order], shard[order]
        out: dict[str, list] = {"shard": [], "hash": [], "place": [], "doc": [], "docs": [], "begin": []}
        edge = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(cand)]]) if len(cand) else np.zeros(1, np.int64)
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            w = cand[lo:hi]
            rows, n = np.unique(b.row[w], return_counts=True)
            out["shard"].append(int(shard[lo]))
            out["hash"].append(b.h[w].tobytes())
            out["place"].append(b.at[w].astype(np.uint32).tobytes())
            out["doc"].append(b.doc_id[rows].tobytes())
            out["docs"].append(n.astype(np.uint32).tobytes())
            out["begin"].append(b.t.bounds[rows].astype(np.uint32).tobytes())
        kinds = {"shard": pa.int32()}
        made = {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()}
        return pa.table({"shard": made.pop("shard"), "block": pa.array([key[0].as_py()] * len(out["shard"]), pa.int64()), **made})

    return run


def _first_places(table: pa.Table) -> pa.Table:
    """For each block, runs of its windows that have a smaller document elsewhere: place, length, source."""
    get = lambda c, t: [np.frombuffer(x.as_py(), t) for x in table.column(c)]
    hashes, places = get("hash", np.uint64), get("place", np.uint32)
    ids, times, begins = get("doc", np.int64), get("docs", np.uint32), get("begin", np.uint32)
    sizes = np.array([len(x) for x in hashes])
    h = np.concatenate(hashes)
    place = np.concatenate(places).astype(np.int64)
    doc = np.concatenate([np.repeat(i, n) for i, n in zip(ids, times, strict=True)])
    offset = place - np.concatenate([np.repeat(i, n) for i, n in zip(begins, times, strict=True)])
    part = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((offset, doc, h))
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    source = np.empty(len(h), np.int64)
    source[order] = head
    i = np.flatnonzero(doc[source] < doc)
    s = source[i]
    start = np.ones(len(i), bool)
    start[1:] = ~((part[i][1:] == part[i][:-1]) & (np.diff(place[i]) == 1) & (doc[i][1:] == doc[i][:-1]) & (doc[s][1:] == doc[s][:-1]) & (np.diff(offset[s]) == 1))
    first = np.flatnonzero(start)
    length = np.diff(np.append(first, len(i)))
    i, s = i[first], s[first]
    edge = np.searchsorted(part[i], np.arange(len(sizes) + 1))
    some = np.flatnonzero(np.diff(edge))
    col = lambda v, t: pa.array([v[edge[k] : edge[k + 1]].astype(t).tobytes() for k in some], pa.binary())
    return pa.table(
        {
            "block": table.column("block").combine_chunks().take(pa.array(some)) if len(some) else pa.array([], pa.int64()),
            "place": col(place[i], np.uint32),
            "length": col(length, np.uint32),
            "ref_doc": col(doc[s], np.int64),
            "ref_start": col(offset[s], np.uint32),
        }
    )


def _factored(words_only: bool):
    def run(docs: pa.Table, runs: pa.Table) -> pa.Table:
        b = Block(docs)
        t = b.t
        get = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_py(), kind) for x in runs.column(c))])
        place, length = get("place", np.uint32).astype(np.int64), get("length", np.uint32).astype(np.int64)
        ref_doc, ref_start = get("ref_doc", np.int64), get("ref_start", np.uint32).astype(np.int64)
        # the first place of each window, here and elsewhere
        _, first, back = np.unique(b.h, return_index=True, return_inverse=True)
        src_doc, src_at = b.doc_id[b.row[first]], b.at[first] - t.bounds[b.row[first]]
        if len(place):
            step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            window_of = np.full(len(t.hash), -1, np.int64)
            window_of[b.at] = np.arange(len(b.at))
            g = back[window_of[np.repeat(place, length) + step]]
            src_doc[g], src_at[g] = np.repeat(ref_doc, length), np.repeat(ref_start, length) + step
        src_doc, src_at = src_doc[back], src_at[back]
        dup = src_doc < b.doc_id[b.row]
        at, row, sd, so = b.at[dup], b.row[dup], src_doc[dup], src_at[dup]
        gone = covered(len(t.hash), at, WINDOW) if len(at) else np.zeros(len(t.hash), bool)
        # greedy factors: as long as the source goes on, too
        new = np.ones(len(at), bool)
        new[1:] = ~((np.diff(at) == 1) & (row[1:] == row[:-1]) & (sd[1:] == sd[:-1]) & (np.diff(so) == 1))
        f = np.flatnonzero(new)
        size = np.diff(np.append(f, len(at))) + WINDOW - 1
        factors = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(row[f], np.arange(t.n + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (at[f] - t.bounds[row[f]], size, sd[f], so[f])], ["start", "length", "ref_doc", "ref_start"]),
        )
        out = {
            "id": b.ids,
            "text": _kept_text(b, gone, words_only),
            "n_words": pa.array(t.counts(), pa.int64()),
            "n_removed": pa.array(t.per_words(gone), pa.int64()),
            "factors": factors,
        }
        return pa.table(out | ({} if b.extra is None else {"extra": b.extra}))

    return run


def _kept_text(b: Block, gone: np.ndarray, words_only: bool) -> pa.Array:
    """The texts without their gone words: kept words with one space between, or the text with the white space after kept words."""
    t = b.t
    data, out = t.raw.tobytes(), []
    any_gone = t.per_words(gone) > 0
    for i in range(t.n):
        lo, hi = t.off[i], t.off[i + 1]
        if not any_gone[i]:
            out.append(b" ".join(data[lo:hi].split()) if words_only else data[lo:hi])
            continue
        a, z = t.bounds[i], t.bounds[i + 1]
        keep = np.flatnonzero(~gone[a:z]) + a
        if not len(keep):
            out.append(b"")
            continue
        split = np.flatnonzero(np.diff(keep) > 1)
        heads, tails = keep[np.concatenate([[0], split + 1])], keep[np.concatenate([split, [len(keep) - 1]])]
        if words_only:
            out.append(b" ".join(x for p, q in zip(heads, tails, strict=True) for x in data[t.start[p] : t.end[q]].split()))
        else:  # each kept run with the white space that followed it
            stop = np.append(t.start, hi)
            out.append(b"".join(data[t.start[p] : (stop[q + 1] if q + 1 < z else hi)] for p, q in zip(heads, tails, strict=True)))
    kept = pa.array(out, pa.binary()).cast(pa.string())
    return kept if words_only else pc.if_else(pc.is_valid(b.text), kept, pa.scalar(None, pa.string()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_only: bool = False, keep: list[str] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per row: id, the ``keep`` columns, ``text`` without duplicate spans, n_words, n_removed and the factors (word offsets; source document and offset).

    ``words_only`` gives the kept words with one space between them; else the
    white space after each kept word stays as it was.
    """
    ship(docs.sparkSession)
    n = docs.count()
    blocks = max(1, math.ceil(n / block_docs))
    shards = max(1, math.ceil(blocks / BLOCKS_PER_SHARD))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *([F.struct(*keep).alias("extra")] if keep else []))
    # rows with a null id have no windows in the index: any block will do
    spread = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("id", "text"))
    placed = src.withColumn("block", F.pmod(spread, F.lit(blocks).cast("long")))
    seeds = placed.groupBy("block").applyInArrow(_seed_rows(shards), "shard int, block long, seeds binary, several binary")
    bits = seeds.groupBy("shard").applyInArrow(_shared_seeds, "shard int, block long, bits binary")
    windows = (
        placed.groupBy("block")
        .cogroup(bits.groupBy("block"))
        .applyInArrow(_window_rows(shards), "shard int, block long, hash binary, place binary, doc binary, docs binary, begin binary")
    )
    runs = windows.groupBy("shard").applyInArrow(_first_places, "block long, place binary, length binary, ref_doc binary, ref_start binary")
    id_type = docs.schema[id_col].dataType.simpleString()
    extra = f", extra {src.schema['extra'].dataType.simpleString()}" if keep else ""
    out = placed.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(_factored(words_only), f"id long, text string, n_words long, n_removed long, factors {FACTORS}{extra}")
    return out.select(F.col("id").cast(id_type).alias(id_col), *[F.col(f"extra.{c}") for c in keep or []], F.col("text").alias(text), "n_words", "n_removed", "factors")
