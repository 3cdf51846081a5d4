"""The training-data operators against brute force, and their defined edge cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftgate.llm import language_id, line_crf, queries
from driftgate.llm.jaccard_join import jaccard_components
from driftgate.llm.line_frequency import line_rules
from driftgate.llm.mixing import mix, ordered, targets
from driftgate.llm.packing import pack
from driftgate.llm.substring_dedup import remove_repeats
from driftgate.llm.url_templates import judge
from driftgate.llm.vector_search import nearest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, hash string, block string"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, f"start {passage} end", "en", "a", 1),
        (2, f"{passage} other", "en", "a", 1),
        (2, f"{passage} other", "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \n\t ", "de", "b", 3),
        (None, passage, "en", "b", 1),
        (6, "long " * 50_000, "en", "b", 1),
        (7, "one two", "de", "b", 7),
        (8, "ONE two", "de", "b", 7),
    ]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def removed(texts):
    """Brute force of the 13-word rule: covered flags by document."""
    first = {}
    for d in sorted(texts):
        w = texts[d]
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    out = {}
    for d, w in texts.items():
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        out[d] = gone
    return out


def test_substring_dedup(spark, docs):
    want = removed({d: words(r.text) for d, r in docs.items()})
    for r in queries.op10_substring_dedup(spark, SF).collect():
        w, gone = words(docs[r.doc_id].text), want[r.doc_id]
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_substring_dedup_edges(odd, empty):
    out = remove_repeats(odd, keep=["hash", "block"]).collect()
    got = collections.defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    assert len(out) == 10 and got[1][0].n_removed == 0
    assert [(r.n_removed, r.text) for r in got[2]] == [(30, "other")] * 2  # repeated rows do not cut each other
    assert got[2][0].factors[0].asDict() == {"start": 0, "length": 30, "ref_doc": 1, "ref_start": 1}
    assert got[None][0].n_removed == 0 and got[3][0].text is None and got[6][0].n_words == 50_000
    assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize(("k", "threshold", "num", "den"), [(3, "0.9", 9, 10), (5, "0.8", 4, 5)])
def test_jaccard(spark, docs, k, threshold, num, den):
    sets = {}
    for d, r in docs.items():
        w = words((r.text or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a]:
                o = len(sets[a] & sets[b])
                if o and den * o >= num * (len(sets[a]) + len(sets[b]) - o):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    for r in jaccard_components(spark.read.parquet(f"{SF}/documents.parquet"), k=k, threshold=threshold).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))


def test_jaccard_edges(odd, empty):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(odd, k=3, threshold="0.9").collect()}
    assert got[7, 1] == got[8, 1] == 7 and got[3, 0] == 3 and got[4, 0] == 4 and got[None, 28] == 1
    assert jaccard_components(empty).count() == 0


def test_line_frequency(spark, docs):
    for r in queries.op3_line_frequency(spark, SF).collect():
        text = docs[r.doc_id].text or ""
        w = words(text)
        times = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = [False] * len(w)
        for i in range(len(w) - 4):
            if times[tuple(w[i : i + 5])] > 1:
                again[i : i + 5] = [True] * 5
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w)) and r.n_repeat_words == sum(again)
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>") and r.n_dup_lines == len(lines) - len(set(lines))


def test_line_frequency_verdict(spark, odd, empty):
    body = lambda i: " ".join(f"own{i}x{j}" for j in range(12))
    rows = [(i, f"Buy  now {i % 10}!\n{body(i)}", "en", "h", 0) for i in range(40)] + [(40, "buy now 3!\nBUY NOW 4!", "en", "h", 0), (41, "buy now 3!", "en", "other", 0)]
    out = {r.doc_id: r for r in line_rules(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)).collect()}
    assert out[0].kept and out[0].lines_removed == 1 and out[0].words_left == 12
    assert not out[40].kept and out[40].words_left == 0
    assert out[41].lines_removed == 0  # another host
    assert line_rules(odd).count() == 10 and line_rules(empty).count() == 0


def test_line_frequency_text(spark, odd):
    """The text without its boilerplate lines, whichever place they have; other texts as they are; copies alike."""
    body = lambda i: "Own " + "x" * (i + 1) + " line,  kept as it is. One two three four five six seven"
    shapes = [("Home | About 0\n{}", "{}"), ("{}\nHOME  | about 5", "{}"), ("{}\n\nhome | about 1\n\nend {}\n", "{}\n\n\nend {}\n"), ("home | about 1\nhome | about 2", "")]
    rows, want = [], {}
    for i in range(40):
        shape, clean = shapes[i % 4]
        rows += [(i, shape.replace("{}", body(i)), "en", "h", 0)] * (2 if i < 4 else 1)
        want[i] = clean.replace("{}", body(i))
    rows += [(40, "home | about 1\n" + body(40), "en", "other", 0), (41, None, "en", "h", 0), (42, "", "en", "h", 0)]
    want |= {40: rows[-3][1], 41: None, 42: ""}
    out = line_rules(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.text == want[r.doc_id] and r.words_left == len(words(r.text)), r
        assert r.lines_removed == (r.doc_id < 40)
    assert sorted((r.doc_id or 0, r.text or "") for r in line_rules(odd).collect()) == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())


def test_line_frequency_limits(spark):
    """Hosts of 20, 50 and 8,000 texts just at and just below a limit; copies count once."""
    rows = []
    # (host, its texts, texts with the line, goes)
    cases = [("h20", 20, 5, True), ("g20", 20, 4, False), ("h50", 50, 11, True), ("g50", 50, 10, False), ("h8000", 8000, 30, True), ("g8000", 8000, 29, False), ("copies", 20, 1, False)]
    for host, n, hold, _ in cases:
        for i in range(n):
            text = f"own {host} " + " ".join(f"{chr(97 + int(d))}w{chr(97 + int(d))}" for d in f"{i:05d}") + " with words of its own to stay here"
            rows += [(len(rows), f"{text}\nhome about contact {host}" if i < hold else text, "en", host, 0)] * (40 if host == "copies" and i < hold else 1)
    out = line_rules(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)).join(spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, host string").distinct(), "doc_id")
    got = {r.host: (r.removed, r.n) for r in out.groupBy("host").agg(F.sum("lines_removed").alias("removed"), F.count("*").alias("n")).collect()}
    for host, n, hold, goes in cases:
        assert got[host] == (hold if goes else 0, n + (39 if host == "copies" else 0)), host


def test_mix(spark, docs, odd, empty):
    got = queries.op4_curriculum_mix(spark, SF).collect()
    assert len(got) == len(docs)
    by = collections.defaultdict(lambda: [0, 0.0, 0, 0])
    for r in got:
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken <= 3 * r.size
        b = by[docs[r.doc_id].source]
        b[0], b[1], b[2], b[3] = b[0] + r.size, r.target, b[2] + r.taken, max(b[3], r.size)
    names = sorted(by, key=lambda s: (s is None, s))
    want = targets([by[s][0] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, t in zip(names, want, strict=True):
        assert by[s][1] == pytest.approx(t) and abs(by[s][2] - t) <= by[s][3]  # whole documents: within one
    rows = ordered(mix(odd)).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and {r.doc_id for r in rows} <= {1, 2, None, 6, 7, 8}
    assert mix(empty).count() == 0


def test_targets_stop_at_the_cap():
    got = targets([10, 1000, 10], [5.0, 2.0, 1.0])
    assert got[0] == 30 and got[2] == 30 and sum(got) == pytest.approx(1020)
    assert targets([0, 0], [1.0, 1.0]) == [0, 0] and targets([], []) == []


def test_packing(spark, docs, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for d, r in docs.items()}
    seqs, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op5_online_packing(spark, SF).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for spans, whole in [*((v, None) for v in seqs.values()), *((pieces[d], len(ids[d])) for d in ids)]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at <= 4096 if whole is None else at == whole
    assert sum(n for v in seqs.values() for _, n in v) > 0.95 * 4096 * len(seqs)
    path = public_tokenizers.path("word_bpe_49k.json")
    got = pack(odd, path).collect()
    assert sum(r.length for r in got if r.doc_id == 3) == 1 and {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert pack(empty, path).count() == 0


def test_vectors(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    got = collections.defaultdict(dict)
    for r in queries.op8_dimension_scan(spark, SF).collect():
        got[r.query_id][r.rank] = r
    hit = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        score[i] = -9
        best = np.lexsort((ids, -score))[:5]
        mine = [got[ids[i]][k] for k in range(1, 6)]
        assert all(abs(r.score - score[ids == r.vec_id][0]) < 1e-12 for r in mine)
        hit, total = hit + len({r.vec_id for r in mine} & set(ids[best].tolist())), total + 5
    assert hit / total >= 0.9


def test_vector_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [1.0]), (8, [0.0, 1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(table, F.col("id") == 0, k=5).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 8, 0.0)]
    assert nearest(table.limit(0), F.col("id") == 0).count() == 0


def test_quality_and_language(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op6_line_crf(spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in got) / len(got) > 0.95
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in queries.op1_output_codes(spark, sf).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) / len(got) > 0.97
    model = language_id.train(odd, F.lit(True))
    out = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert out[3].lang_pred == out[4].lang_pred == out[5].lang_pred == "und" and out[3].score == 0
    assert {r.lang_pred for r in language_id.predict(odd, language_id.train(empty, F.lit(True))).collect()} == {"und"}
    field = line_crf.train(odd, spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id long, quality int"), F.lit(True))
    assert all(0 <= r.score <= 1 for r in line_crf.score(odd, field).collect())
    none = line_crf.train(odd, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert {r.score for r in line_crf.score(odd, none).collect()} == {0.5} and line_crf.score(empty, none).count() == 0


def test_urls(spark):
    rows = [(1, "HTTPS://A.Example.ORG/es/1"), (2, "http://example.org/en/12?x#y"), (3, "http://x.com/de/9#top"), (4, "no host"), (5, None), (6, "http://xorg/"), (7, "http://h.net?q"), (7, "http://h.net?q")]
    got = collections.defaultdict(list)
    for r in judge(spark.createDataFrame(rows, "page_id long, url string"), queries.RULES).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("a.example.org", "/es/1", "example.org/es/", "block")]
    assert got[2] == [("example.org", "/en/12", "example.org/en/1", "block")]
    assert got[3] == [("x.com", "/de/9", "com/de/", "block")]
    assert got[4][0][:3] == got[5][0][:3] == ("", "", None) and got[6][0][2] is None and len(got[7]) == 2
    learned = [(i, f"http://s.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(60)]
    out = judge(spark.createDataFrame(learned, "page_id long, url string"), queries.RULES).collect()
    assert {(r.template, r.verdict) for r in out} == {("/de/*", "block"), ("/fr/*", "allow")}
    assert judge(spark.createDataFrame([], "page_id long, url string"), queries.RULES).count() == 0
