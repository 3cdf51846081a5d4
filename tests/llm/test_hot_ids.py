"""A third of the rows on one id, and a third on the null id, in the mix and in substring dedup."""

from collections import Counter

from pyspark.sql import functions as F

from driftgate.llm import mixing, substring_dedup


def rows_of():
    words = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    hot = [(7, words(i, 5 + i % 11), "a") for i in range(120)]
    null = [(None, words(1000 + i, 4 + i % 7), "a") for i in range(100)] + [(None, None, "a") for _ in range(20)]
    return hot + null + [(100 + i, words(2000 + i, 6 + i % 5), "b" if i % 3 else "a") for i in range(120)]


def test_mix_with_hot_ids(spark, monkeypatch):
    """No bucket holds an id; what is taken is the stream up to the target, whichever way it is cut."""
    docs = spark.createDataFrame(rows_of(), "doc_id long, text string, source string")
    whole = mixing.mix(docs).collect()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    cut = mixing.mix(docs).collect()
    assert len(whole) == len(cut) == 360
    key = lambda r: (r.doc_id, r.text, r["size"], r.source_size, r.copies, tuple(round(p, 6) for p in r.positions))
    assert Counter(map(key, whole)) == Counter(map(key, cut))
    assert all(r.copies == 0 for r in cut if r.text is None)
    for source in ("a", "b"):
        mine = [r for r in cut if r.source == source]
        assert abs(sum(r["size"] * r.copies for r in mine) - mine[0].target) <= max(r["size"] for r in mine)


def test_dedup_with_hot_ids(spark):
    """Rows of one id never cut each other in whatever blocks they lie; rows without an id are kept whole."""
    passage = " ".join(f"p{j}" for j in range(20))
    rows = [(7, f"a{i} {passage}", None) for i in range(60)] + [(None, passage, None)] * 30 + [(None, None, None)] * 10
    rows += [(5, f"first {passage}", None), (9, f"{passage} last", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string")
    for size in (512, 8):
        out = substring_dedup.remove_repeats(docs, words_only=True, block_docs=size).groupBy("doc_id", "n_words", "n_removed").agg(F.count(F.lit(1)).alias("n"))
        got = {(r.doc_id, r.n_words, r.n_removed): r.n for r in out.collect()}
        assert got == {(7, 21, 20): 60, (None, 20, 0): 30, (None, 0, 0): 10, (5, 21, 0): 1, (9, 21, 20): 1}
