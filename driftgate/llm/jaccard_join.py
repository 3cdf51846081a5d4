"""N-gram Jaccard join by universe partition, the pigeonhole principle and exact verification.

Documents are sets of distinct word shingles.  Equal sets form one class, and
only classes are joined.  Sizes fall into bands so narrow that two similar sets
lie in one band or in neighbouring ones; a pair is found in the band of its
smaller set.  There, at most H tokens can differ, and a hash deals the token
universe into segments:

* a plain segment is indexed by its content: two sets agree on it unless a
  token of it differs;
* a one-deletion segment is indexed by its content and by its content without
  each one token: two sets meet there unless two tokens of it differ.

With p plain and d one-deletion segments and p + 2 d > H + t, every similar pair
meets in at least t + 1 plain segments or in a one-deletion segment.  The t
spare segments allow the subset rule: a set with at most t plain segments of
no or few tokens leaves those unindexed (nearly empty segments are
the ones that unrelated sets share).  ``allocate`` takes for each band the p
and d of least estimated cost, index entries plus chance meetings, from the
band's number of sets.  Every choice is a function of content and band, so
both sets of a pair make the same one.

Index entries are dealt to shards as packed arrays, pre-aggregated for each
task: an entry many sets of one task share goes there once.  Classes
that meet are then linked without listing all pairs: each meeting tests its
members against leaders, first the one that is in most meetings; tested leaders
leave, components merge, and meetings inside one component are done.  What is
left runs again, so no link that changes a component is lost.  A pair is tested
only if sizes and parity bits allow it (sets differ in no fewer tokens than
bits, so this loses nothing).  Tests are exact, on the shingles of whole texts.

Defined cases: A-Z is lower-cased; a text with fewer words than a shingle is one
shingle of all its words; null texts and texts without words have the empty set
and link with nothing; a row with a null id takes part, and a component's id is
the smallest non-null id in it (null if there is none); repeated rows are equal
sets; an empty table gives no rows.  Classes and shingles are 64-bit hashes.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.components import merged
from driftgate.llm.store import checkpointed, drop, ship, stash
from driftgate.llm.words import Texts, mix, prefix_sum, run_hash, slices, spans_hash

SHARED = 1e-3  # assumed chance that a token of one set is in an unrelated one
FLUSH_ENTRIES = 500_000
LISTED = 8  # sets of one task and entry that are listed one by one
ENTRIES_PER_SHARD = 700_000
LEADERS = 1_024  # of a meeting, in each round after the first
BITS = 512
WIDE_FROM = 768  # tokens from which a set has more parity bits, in a column of its own


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted in each text, and the first one of each text."""
    t = Texts(column, "lower")
    at, h = t.windows(k)
    doc = t.doc[at]
    counts = t.counts()
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = mix(spans_hash(prefix_sum(t.hash), t.bounds[short], t.bounds[short + 1]) ^ np.uint64(k))
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(t.n + 1))


def _sums(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:], dtype=np.uint64)
    return total[cut[1:]] - total[cut[:-1]]


def classes(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set; 0 is the empty set's."""
    n = np.diff(cut)
    c = mix(_sums(mix(h ^ np.uint64(0xC1A55)), cut) + mix(n.astype(np.uint64)))
    return np.where(n > 0, c | np.uint64(1), np.uint64(0)).view(np.int64)


class Bands:
    """Size bands for a threshold: sets of band i start at sizes[i]."""

    def __init__(self, threshold: Fraction, largest: int):
        self.j = threshold
        sizes = [1]
        while sizes[-1] <= largest:
            sizes.append(sizes[-1] * threshold.denominator // threshold.numerator + 1)
        self.sizes = np.array(sizes, np.int64)

    def band(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.sizes, n, "right") - 1

    def most(self, i: int) -> int:
        """The largest smaller set of join band i."""
        return int(self.sizes[i + 1] - 1)

    def partner(self, i: int) -> int:
        """The largest set that can link in join band i."""
        return self.most(i) * self.j.denominator // self.j.numerator

    def differ(self, i: int) -> int:
        """H: tokens that can differ between two linked sets of join band i."""
        return self.most(i) * (self.j.denominator - self.j.numerator) // self.j.numerator


def allocate(n: int, h: int, sets: int) -> tuple[int, int, int, int]:
    """(plain segments, one-deletion segments, spare ones, tokens an indexed plain segment must have) for sets of n tokens, H = h, by least estimated cost."""
    best = None
    for d in sorted({0, 1, *(round((h + 1) / 2 * x / 8) for x in range(9)), (h + 2) // 2}):
        need = max(0, h + 1 - 2 * d)
        for least in (2, 1, 0) if need else (0,):
            spare = 0
            for _ in range(12 if least else 0):  # spare segments make all segments smaller
                a = n / (need + spare + d)
                few = (need + spare) * math.exp(-a) * (1 + a if least == 2 else 1)
                spare = math.ceil(few + 4 * math.sqrt(few))
                if spare > need:
                    break
            p = need + spare
            if p + d == 0 or spare > need / 3:
                continue
            a = n / (p + d)
            # two unrelated sets agree on the smallest indexed content: surely if it is empty, else if they share those tokens
            alike = math.exp(-2 * a) * (a**least / math.factorial(least)) ** 2 * SHARED**least
            cost = sets * (p + d * (1 + a)) + sets * sets / 2 * (p * alike + d * (math.exp(-a) * (1 + a)) ** 2)
            if best is None or cost < best[0]:
                best = (cost, (p, d, spare, least))
    return best[1]


def _entries(h: np.ndarray, cut: np.ndarray, join_band: np.ndarray, plan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index entries (hash, row) of sets in the given join band each (-1: none)."""
    use = (join_band >= 0) & (plan[np.maximum(join_band, 0), :2].sum(axis=1) > 0) & (np.diff(cut) > 0)
    rows = np.flatnonzero(use)
    if not len(rows):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    band = join_band[rows]
    p, d, spare, least = plan[band].T
    size = np.diff(cut)[rows]
    row = np.repeat(np.arange(len(rows)), size)
    pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(cut[:-1][rows], size)
    token = h[pos]
    u = mix(token + np.uint64(0x5E6))
    v = mix(token ^ np.uint64(0x70CE))
    segments = p + d
    base = np.cumsum(segments) - segments
    slot = base[row] + ((u >> np.uint64(32)) * segments[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    total = int(segments.sum())
    # exact 64-bit sums from two halves that float sums hold exactly
    lo = np.bincount(slot, (v & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
    hi = np.bincount(slot, (v >> np.uint64(32)).astype(np.float64), total).astype(np.uint64)
    content = lo + (hi << np.uint64(32))
    tokens = np.bincount(slot, minlength=total)
    of = np.repeat(np.arange(len(rows)), segments)
    seg = np.arange(total) - base[of]
    tag = mix((band[of].astype(np.uint64) << np.uint64(32)) + seg.astype(np.uint64))
    whole = mix(content + tag)
    few = (seg >= d[of]) & (tokens < least[of])
    n_few = np.bincount(of, few, len(rows))
    skip = few & (spare[of] > 0) & (n_few[of] <= spare[of])
    deleted = np.flatnonzero(slot - base[row] < d[row])
    out = np.concatenate([whole[~skip], mix(content[slot[deleted]] - v[deleted] + tag[slot[deleted]])])
    return out, rows[np.concatenate([of[~skip], row[deleted]])]


def _index_rows(k: int, bands: Bands, plan: np.ndarray, shards: int):
    """Tasks' index entries by shard: kind 0 lists sets for entries; kind 1 are members of entries that many sets of the task share."""

    def packed(entry: np.ndarray, cls: np.ndarray):
        order = np.lexsort((cls, entry))
        entry, cls = entry[order], cls[order]
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (cls[1:] != cls[:-1])
        entry, cls = entry[new], cls[new]
        first = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])) if len(entry) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(entry)))
        many = np.repeat(times > LISTED, times)
        keep = ~many
        keep[first] = True
        shard = ((entry >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        out = []
        for kind, pick in ((0, keep), (1, many)):
            at = np.flatnonzero(pick)
            edge = np.searchsorted(shard[at], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(edge)):
                i = at[edge[s] : edge[s + 1]]
                names, number = np.unique(cls[i], return_inverse=True)
                # members pass through any shard: these are spread, as their entry may be a hot one
                to = int(s) if kind == 0 else int((int(names[0]) + s) % shards)
                out.append((to, kind, entry[i].tobytes(), names.tobytes(), number.astype(np.uint16 if len(names) <= 1 << 16 else np.uint32).tobytes(), np.packbits(many[i]).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(zip(*out, strict=True) if out else [[]] * 6, (pa.int32(), pa.int8(), *[pa.binary()] * 4), strict=True)],
            ["shard", "kind", "entry", "names", "cls", "many"],
        )

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                h, cut = shingle_sets(batch.column(0).slice(lo, hi - lo), k)
                n, cls = np.diff(cut), classes(h, cut)
                _, first = np.unique(cls, return_index=True)
                once = np.zeros(len(n), bool)
                once[first] = True
                band = np.where(once & (n > 0), bands.band(n), -1)
                lower = np.where((band > 0) & (n <= bands.sizes[np.maximum(band, 0)] * bands.j.denominator // bands.j.numerator), band - 1, -1)
                for join in (band, lower):
                    entry, row = _entries(h, cut, join, plan)
                    held.append((entry, cls[row]))
                    count += len(entry)
                if count >= FLUSH_ENTRIES:
                    yield packed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, count = [], 0
        if held:
            yield packed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _meetings(table: pa.Table) -> pa.Table:
    """Members (meeting, class) of the entries of a shard that two or more classes share."""
    kind = np.asarray(table.column("kind").combine_chunks())
    raw = {c: [x.as_py() for x in table.column(c)] for c in ("entry", "names", "cls", "many")}
    entry = [np.frombuffer(x, np.uint64) for x in raw["entry"]]
    cls = [np.frombuffer(n, np.int64)[np.frombuffer(i, np.uint16 if len(i) == len(e) // 4 else np.uint32)] for n, i, e in zip(raw["names"], raw["cls"], raw["entry"], strict=True)]
    through = [i for i in range(len(kind)) if kind[i]]
    here = [i for i in range(len(kind)) if not kind[i]]
    out = [[x[i] for i in through] for x in (entry, cls)]
    if here:
        e, c = (np.concatenate([x[i] for i in here]) for x in (entry, cls))
        many = np.concatenate([np.unpackbits(np.frombuffer(raw["many"][i], np.uint8), count=len(entry[i])).astype(bool) for i in here])
        order = np.lexsort((~many, c, e))
        e, c, many = e[order], c[order], many[order]
        new = np.ones(len(e), bool)
        new[1:] = (e[1:] != e[:-1]) | (c[1:] != c[:-1])
        e, c, many = e[new], c[new], many[new]
        first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
        times = np.diff(np.append(first, len(e)))
        any_many = np.add.reduceat(many, first, dtype=np.int64) > 0
        # entries that share all their members are one meeting
        name = mix(np.add.reduceat(mix(c.view(np.uint64)), first) + times.astype(np.uint64))
        name = np.where(any_many, e[first], name)
        met = (times > 1) | any_many
        _, once = np.unique(name, return_index=True)
        keep = np.zeros(len(first), bool)
        keep[once] = True
        pick = np.repeat(keep & met, times) & ~many
        out[0].append(np.repeat(name, times)[pick])
        out[1].append(c[pick])
    meeting, cls = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
    return pa.table({"meeting": pa.array(meeting.view(np.int64), pa.int64()), "cls": pa.array(cls, pa.int64())})


def _identify(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                h, cut = shingle_sets(part.column(1), k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(cut), pa.int64()), pa.array(classes(h, cut), pa.int64())], ["id", "size", "cls"])

    return run


def _class_texts(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                part = batch.column(0).slice(lo, hi - lo)
                h, cut = shingle_sets(part, k)
                cls = classes(h, cut)
                _, first = np.unique(cls, return_index=True)
                first = first[cls[first] != 0]
                bits, wide = parity_bits(h, cut)[first], wide_bits(h, cut)
                bits = pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel(), pa.int64()), BITS // 64).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(cls[first], pa.int64()), pa.array(np.diff(cut)[first], pa.int64()), part.take(pa.array(first)), bits, pa.array([wide[i] for i in first], pa.binary())], ["cls", "size", "text", "bits", "wide"])

    return run


def parity_bits(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Each set's tokens hashed to ``BITS`` bits, a bit being their parity: two sets differ in no fewer tokens than bits."""
    row = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    at = row * BITS + (mix(h ^ np.uint64(0xB17)) & np.uint64(BITS - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=(len(cut) - 1) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(cut) - 1, BITS), axis=1).view(np.int64)


def wide_bits(h: np.ndarray, cut: np.ndarray) -> list[bytes | None]:
    """Parity bits of larger sets, about one for two tokens; halves fold onto each other for a set of another length."""
    out: list[bytes | None] = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a < WIDE_FROM:
            out.append(None)
            continue
        bits = 1 << (b - a - 1).bit_length() - 1
        at = (mix(h[a:b] ^ np.uint64(0xB17)) & np.uint64(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes())
    return out


def _plausible(num: int, den: int):
    """Of rows (a, b, sizes, wide_a, wide_b), the pairs whose wide bits allow the similarity."""

    def run(batches):
        for batch in batches:
            good = []
            for total, x, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint8)
                if len(x) < len(y):
                    x, y = y, x
                while len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                good.append(int(np.bitwise_count(x ^ y).sum()) * (den + num) <= total * (den - num))
            pick = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pick) for c in (0, 1)], ["a", "b"])

    return run


def _verified(k: int, num: int, den: int):
    """Of rows (a, b, text_a, text_b), the pairs (a, b) with a similarity of num / den or more."""

    def sets(batch, ids, texts, lo, hi):
        key = np.asarray(batch.column(ids).slice(lo, hi - lo))
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        h, cut = shingle_sets(batch.column(texts).slice(lo, hi - lo).take(pa.array(first)), k)
        return h, cut, back

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(3)):
                ha, ca, ia = sets(batch, 0, 2, lo, hi)
                hb, cb, ib = sets(batch, 1, 3, lo, hi)
                good = []
                for r in range(hi - lo):
                    x, y = ha[ca[ia[r]] : ca[ia[r] + 1]], hb[cb[ib[r]] : cb[ib[r] + 1]]
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    good.append(den * common >= num * (len(x) + len(y) - common))
                pick = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo).filter(pick) for c in (0, 1)], ["a", "b"])

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, threshold: str = "0.8") -> DataFrame:
    """Per row: id, n_shingles and component_id, the smallest id reachable by links of ``threshold`` or more."""
    spark = docs.sparkSession
    ship(spark)
    j = Fraction(threshold)
    num, den = j.numerator, j.denominator
    texts = docs.select(F.col(text).cast("string").alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    base = checkpointed(
        docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(_identify(k), f"id {id_type}, size long, cls long")
    )
    links = _links(texts, base, k, j, num, den)
    named = base.where("cls <> 0").groupBy("cls").agg(F.min("id").alias("least"))
    if links is not None:
        comp = links.withColumnRenamed("node", "cls")
        joined = named.join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        least = joined.groupBy("component").agg(F.min("least").alias("smallest"))
        named = joined.select("cls", "component").join(least, "component").select("cls", F.col("smallest").alias("least"))
    out = base.join(named.withColumnRenamed("cls", "of"), F.col("cls") == F.col("of"), "left")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.when(F.col("cls") == 0, F.col("id")).otherwise(F.col("least")).alias("component_id"))


def _links(texts: DataFrame, base: DataFrame, k: int, j: Fraction, num: int, den: int) -> DataFrame | None:
    """(node, component) over classes, or None without any link."""
    spark = texts.sparkSession
    largest = base.agg(F.max("size")).first()[0] or 0
    bands = Bands(j, largest + 1)
    # one number for each band: as many as the logarithm of the longest text
    width = F.lit(bands.sizes.tolist())
    band = F.size(F.filter(width, lambda s: s <= F.col("size"))) - 1
    held = dict(base.where("size > 0").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect())
    plan = np.zeros((len(bands.sizes), 4), np.int64)
    entries = 0
    for i in range(len(bands.sizes) - 1):
        sets = held.get(i, 0) + held.get(i + 1, 0)
        if sets and bands.differ(i):  # else only equal sets link
            plan[i] = allocate(bands.most(i), bands.differ(i), sets)
            entries += sets * int(plan[i][0] + plan[i][1] * (1 + bands.most(i) // max(1, plan[i][:2].sum())))
    if not entries:
        return None
    shards = max(1, math.ceil(entries / ENTRIES_PER_SHARD))
    index = texts.mapInArrow(_index_rows(k, bands, plan, shards), "shard int, kind byte, entry binary, names binary, cls binary, many binary")
    members = checkpointed(index.groupBy("shard").applyInArrow(_meetings, "meeting long, cls long").distinct())
    active = members.select("cls").distinct()
    by_class = texts.mapInArrow(_class_texts(k), "cls long, size long, text string, bits array<long>, wide binary").join(active, "cls", "left_semi").groupBy("cls").agg(F.any_value("text").alias("text"), F.any_value("bits").alias("bits"), F.any_value("size").alias("size"), F.any_value("wide").alias("wide"))
    by_class, path = stash(by_class)
    # how many meetings a class is in: the text that others are copies of is in most
    degree = members.groupBy("cls").agg(F.count(F.lit(1)).alias("degree"))
    members = checkpointed(members.join(by_class.select("cls", "size", "bits"), "cls").join(degree, "cls"))
    label, leaders = None, 1
    while True:
        at = members.withColumn("component", F.col("cls")) if label is None else members.join(label, F.col("cls") == F.col("node"), "left").select(*members.columns, F.coalesce("component", "cls").alias("component"))
        mixed = at.groupBy("meeting").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("meeting")
        open_ = checkpointed(at.join(mixed, "meeting", "left_semi"))
        if open_.isEmpty():
            break
        salt = F.pmod(F.col("cls"), F.lit(leaders))
        best = F.struct((-F.col("degree")).alias("order"), "cls", "size", "component", "bits")
        lead = open_.groupBy("meeting", salt.alias("salt")).agg(F.min(best).alias("l")).select(F.col("meeting").alias("of"), "l")
        sizes = (F.col("size") * den >= F.col("l.size") * num) & (F.col("l.size") * den >= F.col("size") * num)
        apart = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("l.bits")[i])) for i in range(BITS // 64)), F.lit(0))
        close = apart * (den + num) <= (F.col("size") + F.col("l.size")) * (den - num)
        pairs = open_.join(lead, (F.col("meeting") == F.col("of")) & (F.col("component") != F.col("l.component")) & sizes & close)
        total, large = F.col("size") + F.col("l.size"), F.least("size", "l.size") >= WIDE_FROM
        # written tables, not checkpoints: their sizes are known, so few pairs fetch texts without shuffling these
        pairs, *old = stash(pairs.select(F.least("cls", "l.cls").alias("a"), F.greatest("cls", "l.cls").alias("b"), total.alias("total"), large.alias("large")).distinct())
        # large sets: their wide bits travel first, a small part of their texts
        wide = by_class.select("cls", "wide")
        big = pairs.where("large").join(wide.toDF("a", "wide_a"), "a").join(wide.toDF("b", "wide_b"), "b")
        big = big.select("a", "b", "total", "wide_a", "wide_b").mapInArrow(_plausible(num, den), "a long, b long")
        pairs, path_of = stash(pairs.where("not large").select("a", "b").union(big))
        old.append(path_of)
        text = by_class.select("cls", "text")
        left, right = pairs.join(text.toDF("a", "text_a"), "a"), pairs.join(text.toDF("b", "text_b"), "b")
        found = left.join(right, ["a", "b"]).select("a", "b", "text_a", "text_b").mapInArrow(_verified(k, num, den), "a long, b long")
        edges = checkpointed(found)
        for x in old:
            drop(spark, x)
        if not edges.isEmpty():
            label = merged(label, edges)
        gone = lead.select(F.col("of").alias("meeting"), F.col("l.cls").alias("cls"))
        members = open_.join(gone, ["meeting", "cls"], "left_anti").drop("component")
        leaders = LEADERS
    drop(spark, path)
    return label
