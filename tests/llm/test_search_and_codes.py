"""Notice search, pivot codes and lexical search against brute force, and their defined edge cases."""

import collections
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from driftgate.llm import lexical_search, pivot_codes, queries
from driftgate.llm.lexical_search import Asked, search, terms_of
from driftgate.llm.notice_search import NOTICES, Notice, Scanner, pieces, scan_notices
from driftgate.llm.pivot_codes import assign, choose_pivots, coded, compress, root, squared

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


# notice search


def base_of(text):
    w = words(text)
    at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(phrase)]) == phrase]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_notices_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_notice_search(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1)


def distance_inside(wording, text):
    """The fewest edits of a wording that starts and ends at word boundaries of the text."""
    w = text.split(" ")
    best = len(wording)
    for a in range(len(w)):
        for b in range(a + 1, len(w) + 1):
            part = " ".join(w[a:b])
            if abs(len(part) - len(wording)) < best:
                row = list(range(len(part) + 1))
                for i, x in enumerate(wording, 1):
                    prev, row[0] = row[0], i
                    for j, y in enumerate(part, 1):
                        prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
                best = min(best, row[-1])
    return best


def test_every_edit_within_the_bound_is_found():
    """Random edits of a notice: found if and only if some stretch of whole words is within the bound."""
    rng = np.random.default_rng(5)
    notice = Notice("gpl", "", "the general public license v", 2)
    scanner = Scanner([notice])
    hits = 0
    for _ in range(300):
        text = list(notice.wording)
        for _ in range(rng.integers(0, 5)):
            i, c = int(rng.integers(len(text))), "aegl "[rng.integers(5)]
            text[i : i + int(rng.integers(2))] = [c] if rng.integers(2) else []
        body = " ".join("".join(text).split())
        got = scanner.spans(f" the {body} of it ")
        near = distance_inside(notice.wording, f"the {body} of it")
        assert bool(got) == (near <= 2), body
        assert all(e >= near for *_, e in got)
        hits += bool(got)
    assert 50 < hits < 300


def test_pieces_tile_the_wording():
    for n in NOTICES:
        cut = pieces(n.wording, n.edits)
        assert "".join(p for _, p in cut) == n.wording and len(cut) > n.edits and all(p for _, p in cut)


def test_notice_cases(spark):
    rows = [
        (1, "Released under the MIT Licence!", "mit", ""),
        (2, "a limit license, emit license, it license, omit\nlicense", "", ""),  # no notice: the head must stand
        (3, "MIT license mit license; Apache-License", "apache,mit", "apache,mit"),
        (4, "GNU Genral Public Lisense", "gpl", ""),
        (5, "Permission is hereby granted, free of charge, to any persn who obtains a copy", "mit", ""),
        (6, None, "", ""),
        (7, "", "", ""),
        (8, "CC BY-NC 4.0 and CC BY ND", "cc-by-nc", ""),
        (9, "é mit license é " + "word " * 200_000 + "general public license", "gpl,mit", "gpl,mit"),
        (9, "mit\nlicense", "mit", "mit"),
        (None, "apache license", "apache", "apache"),
    ]
    table = spark.createDataFrame([(i, t, "x", 7) for i, t, *_ in rows], "doc_id long, text string, labels string, n_words int")
    got = collections.Counter((r.doc_id, r.labels, r.base_labels) for r in scan_notices(table, queries.PHRASES).collect())
    assert got == collections.Counter((i, labels, base) for i, _, labels, base in rows)
    long = next(r for r in scan_notices(table, queries.PHRASES).collect() if r.n_words > 1000)
    assert (long.first_word, long.last_word) == (1, 200_004) and long.spans[0].asDict() == {"label": "mit", "first_word": 1, "words": 2, "edits": 0}
    assert scan_notices(table.limit(0), queries.PHRASES).count() == 0
    text_ids = spark.createDataFrame([("a", "mit license")], "doc_id string, text string")
    assert scan_notices(text_ids, [], notices=[]).first().labels == ""


# pivot codes


def brute_codes(rows):
    """(codes, errors, codebooks) of integer vectors in id order, measuring every entry."""
    x = np.array(rows, np.int64)
    parts = np.stack(np.split(x, 4, axis=1))
    books = parts[:, :256].copy()

    def near():
        d = ((parts[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(4):
        at, _ = near()
        for j in range(4):
            for e in range(books.shape[1]):
                if (at[j] == e).any():
                    books[j, e] = [sum(c) // len(c) for c in parts[j, at[j] == e].T.tolist()]
    at, d = near()
    return ["".join(f"{e:02x}" for e in c) for c in at.T], d.sum(axis=0).tolist(), books


def test_codes_of_a_table(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 16)).astype(np.float32)
    x[400:500] = x[3]  # a very common vector
    rows = [(i, v.tolist(), None if i % 7 == 0 else i % 3, "x") for i, v in enumerate(x)]
    bad = [(-1, None, 0, "x"), (-2, [1.0] * 15 + [None], 0, "x"), (-3, [float("nan")] * 16, 0, "x"), (-4, [float("inf")] * 16, 0, "x"), (-5, [1.0] * 12, 0, "x"), (-6, [], 0, "x")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int, code string").repartition(5)
    got = {r.vec_id: r for r in coded(table).collect()}
    codes, errors, books = brute_codes([[math.floor(1024 * c) for c in v] for _, v, *_ in rows])
    by_label = collections.Counter()
    for (_, _, label, _), e in zip(rows, errors, strict=True):
        by_label[label] += e
    assert len(got) == 700
    for (i, _, label, _), code, error in zip(rows, codes, errors, strict=True):
        assert (got[i].code, got[i].error, got[i].label_error) == (code, error, by_label[label])
    text = ",".join(str(c) for part in books.tolist() for entry in part for c in entry)
    assert got[0].codebooks_sha256 == hashlib.sha256(text.encode()).hexdigest()
    done, _ = compress(table)
    assert 0 < done.agg({"measured": "sum"}).first()[0] < 0.9 * 700 * 4 * 256  # pivots spare evaluations


def test_codes_edges(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(2, [0.0, 0.0, 0.0, 1.0], "a"), (1, [0.0, 0.0, 0.0, -1.0], None), (1, [0.0, 0.0, 0.0, -1.0], None), (None, [0.0, 0.0, 0.0, 0.5], "a")]
    got = sorted((r.vec_id or 9, r.code, r.error, r.label_error) for r in coded(spark.createDataFrame(rows, schema)).collect())
    # entries are rows by id (null last); equal entries: the lower index
    assert got == [(1, "00000000", 0, 0), (1, "00000000", 0, 0), (2, "00000002", 0, 0), (9, "00000003", 0, 0)]
    assert coded(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="64-bit"):
        coded(spark.createDataFrame([(1, [1e9] * 4, "a")], schema))


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(9)
    for scale in (3, 1000, 60_000 * 1024):
        entries, x = rng.integers(-scale, scale, (100, 6)), rng.integers(-scale, scale, (500, 6))
        entries[50:60] = entries[7]
        x[:50] = entries[:50]
        pivots = choose_pivots(entries, 5)
        d = squared(x, entries)
        near, dist, _ = assign(x, root(squared(x, pivots)), entries, pivots)
        assert (near == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    r = np.array([0, 1, 2, 3, 4, 10**12 - 1, 10**12, (3 * 10**9) ** 2 - 1])
    assert root(r).tolist() == [math.isqrt(int(v)) for v in r]


# lexical search


def brute_search(docs, items, k=20):
    terms = {d: TERM.findall((t or "").translate(LOWER)) for d, t in docs}
    size = {d: len(t) for d, t in terms.items() if t}
    n, length = len(size), sum(size.values())
    tf = {d: collections.Counter(t) for d, t in terms.items()}
    df = collections.Counter(t for c in tf.values() for t in c)
    out = {}
    for item, text in items:
        scored = []
        for d in size:
            m = 75 + (25 * size[d] * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[d][t]) // (1000 * tf[d][t] + 12 * m)) for t in TERM.findall((text or "").translate(LOWER)) if tf[d][t])
            if s > 0:
                scored.append((-s, d))
        out[item] = [(d, -s) for s, d in sorted(scored)[:k]]
    return out


def ranked(df):
    out = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r["rank"])):
        out[r.item_id].append((r.doc_id, r.score))
        assert len(out[r.item_id]) == r["rank"]
    return out


def test_search_of_the_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ranked(queries.op13_lexical_search(spark, SF)) == {i: v for i, v in brute_search(docs, items).items() if v}


def test_search_edges(spark):
    docs = [(i, "Alpha beta" + " gamma" * (i % 3), "x", 1) for i in range(60)] + [(100, None, "x", 1), (101, " .,;", "x", 1), (102, "ÄÖ é9 " + "pad " * 100_000, "x", 1), (7, "alpha", "y", 2), (None, "delta alpha", "z", 3)]
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id string, rank int")
    items = spark.createDataFrame([(1, "ALPHA alpha gamma!"), (2, None), (3, "nowhere"), (4, "é9"), (5, ""), (None, "beta"), (6, "delta")], "item_id long, text string")
    got = ranked(search(table, items, k=20))
    assert set(got) == {1, 4, 6} and [d for d, _ in got[4]] == [102] and [d for d, _ in got[6]] == [None]
    assert len(got[1]) == 20 and [d for d, _ in got[1]] == [2 + 3 * i for i in range(20)]  # ties by id
    assert search(table.limit(0), items).count() == 0 and search(table, items.limit(0)).count() == 0


def test_blocks_of_items_and_chunks_of_strata(spark, monkeypatch):
    """Items in several blocks give what one block gives; small chunks and late strata lose nothing."""
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = ranked(search(docs, items, k=3))
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 9)
    assert ranked(search(docs, items, k=3)) == whole
    rng = np.random.default_rng(2)
    n, v = 400, 30
    m, lists = np.sort(rng.integers(75, 90, n)), [np.sort(rng.choice(v, rng.integers(1, 9), replace=False)) for _ in range(n)]
    tfs = [rng.integers(1, 6, len(t)) for t in lists]
    asked = Asked(list(range(12)), [{int(t): 1 + int(t) % 2 for t in rng.choice(v, 6, replace=False)} for _ in range(12)], rng.integers(0, 4, v))
    ids = rng.permutation(n)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(m), pa.array([t.tolist() for t in lists]), pa.array([t.tolist() for t in tfs])], ["id", "m", "terms", "tfs"])
    want = set()
    for j in range(12):
        q = dict(zip(asked.term[asked.cut[j] : asked.cut[j + 1]].tolist(), asked.worth[asked.cut[j] : asked.cut[j + 1]].tolist(), strict=True))
        scored = [(-sum(q.get(int(t), 0) * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[i]))) for t, f in zip(lists[i], tfs[i], strict=True)), int(ids[i])) for i in range(n)]
        want |= {(j, d, -s) for s, d in sorted(x for x in scored if x[0] < 0)[:5]}
    for chunk in (10, 100, 10**6):
        monkeypatch.setattr(lexical_search, "CHUNK_POSTINGS", chunk)
        out = next(lexical_search._search(asked, v, 5)(iter([batch.slice(0, 150), batch.slice(150)]))).to_pylist()
        assert {(r["no"], r["doc_id"], r["score"]) for r in out} == want


def test_terms():
    terms, row = terms_of(pa.array(["Ab,c-É9", None, "", "x", "y z"]))
    assert [t.decode() for t in terms.to_pylist()] == ["ab", "c", "É9", "x", "y", "z"] and row.tolist() == [0, 0, 0, 3, 4, 4]
