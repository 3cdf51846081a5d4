"""The pipeline's stages: what each keeps, against brute force on what it was given."""

import re

import corpus_pipeline as P
from driftgate.llm.store import stash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {"documents": docs}
    for name, stage in P.STAGES:
        docs, _ = stash(stage(spark, docs, SF))
        seen[name] = docs
        assert name == "packing" or docs.columns == columns
    rows = {k: v.collect() for k, v in seen.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows["quality"]}
    good = [r.doc_id for r in rows["documents"] if labels.get(r.doc_id) == 1]
    bad = [r.doc_id for r in rows["documents"] if labels.get(r.doc_id) == 0]
    assert sum(d in kept for d in good) >= 0.98 * len(good) and sum(d in kept for d in bad) <= 0.1 * len(bad)

    def shingles(text):
        w = [x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [shingles(r.text) for r in rows["near_duplicates"]]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or 5 * len(a & b) < 4 * len(a | b)
    assert {r.doc_id for r in rows["near_duplicates"]} <= kept
    assert {r.doc_id for r in rows["mixing"]} <= {r.doc_id for r in rows["substring_dedup"]}
    assert sum(r.length for r in rows["packing"]) > 0
    assert {r.doc_id for r in rows["packing"]} == {r.doc_id for r in rows["mixing"]}


def test_training_order_reaches_the_sequences(spark):
    """Positions of the mix against sequence ids, over many files of uneven size that a scan deals out of order."""
    from driftgate.llm import queries
    from driftgate.llm.mixing import mix, ordered

    text = "word{} more words of this text and some others {}"
    rows = [(i, text.format(i, "filler " * (i * 37 % 400)), "en", f"s{i % 3}", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    place = {}
    for r in ordered(mix(docs)).collect():
        place.setdefault(r.doc_id, []).append(r.position)
    one = {d for d, p in place.items() if len(p) == 1}
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        mixed, _ = stash(P.mixing(spark, docs, SF))
        got = P.packing(spark, mixed, SF).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.doc_id for r in got} == set(place) and len(got) >= sum(map(len, place.values()))
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
    first = []
    for _, pieces in sorted(seqs.items()):
        known = [place[r.doc_id][0] for r in sorted(pieces, key=lambda r: r.offset) if r.doc_id in one]
        assert known == sorted(known)
        if min(pieces, key=lambda r: r.offset).doc_id in one:
            first.append(known[0])
    assert len(first) > 20 and first == sorted(first)
    used = [r.positions[0] if r.positions else float("inf") for r in queries.op4_curriculum_mix(spark, SF).collect()]
    assert used == sorted(used)


def test_texts_under_one_id_are_kept_apart(spark):
    body = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(1, body("a"), "en", "s", 1), (1, body("b"), "en", "s", 1), (1, body("a"), "en", "r", 1), (2, body("a"), "en", "s", 1), (None, body("a"), None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id or 9), (r.text or "")[:2], r.source) for r in P.near_duplicates(spark, docs, SF).collect())
    assert got == [(1, "a0", "r"), (1, "b0", "s"), (3, "", "s"), (4, "", "s"), (9, "a0", None)]
    assert P.near_duplicates(spark, docs.limit(0), SF).count() == 0
