"""Repeated and hot rows of the vector search; which urls the template tree may judge."""

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from driftgate.llm import queries, vector_search
from driftgate.llm.url_templates import judge


def test_repeated_query_rows_and_a_hot_id(spark, monkeypatch):
    """Repeated rows are one row; own rows, however many, leave every place to neighbours; split queries find the same."""
    at = lambda i, a: (i, [math.cos(a), math.sin(a)], 0.5, 7, None, 1)
    hot = [at(50, 0.025 + 1e-5 * j) for j in range(40)]  # nearer to each other than to any other row
    rows = [at(0, 0.0)] * 8 + [at(i, 0.01 * i) for i in range(1, 10)] + hot + [at(3, 0.03)] * 5
    # columns with clashing names take no part
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double, rank int, query_id long, list int")
    different = sorted({(i, tuple(v)) for i, v, *_ in rows})
    ids, x = np.array([i for i, _ in different]), np.array([v for _, v in different])
    want = Counter()
    for i, v in different:
        if i % 50 == 0:
            cos = x @ np.array(v)
            mine = [j for j in np.lexsort((ids, -cos)) if ids[j] != i][:5]
            want[i, tuple(ids[mine].tolist())] += 1
    for asked in (65_536, 3):
        monkeypatch.setattr(vector_search, "ASKED_ROWS", asked)
        got = defaultdict(list)
        for r in vector_search.nearest(table, F.col("id") % 50 == 0, k=5).orderBy("query_id", "query_key", "rank").collect():
            got[r.query_id, r.query_key].append(r.vec_id)
        assert Counter((i, tuple(v)) for (i, _), v in got.items()) == want


def test_more_own_rows_than_places_in_every_block(spark, monkeypatch):
    """Blocks of a few rows, most of them the query's own."""
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(3)
    rows = [(0, (np.array([1.0, 0, 0, 0]) + 0.01 * rng.standard_normal(4)).tolist()) for _ in range(60)] + [(i, rng.standard_normal(4).tolist()) for i in range(1, 13)]
    out = vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0, k=12)
    per = out.groupBy("query_key").agg(F.count_distinct("vec_id").alias("n"), F.max("rank").alias("last")).collect()
    assert len(per) == 60 and all((r.n, r["last"]) == (12, 12) for r in per)


def verdicts(spark, urls):
    rows = judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), queries.RULES).collect()
    assert len(rows) == len(urls)
    return {r.page_id: r for r in rows}


def test_unlabelled_sections_of_a_host_stay(spark):
    """120 sections without a label beside a blocked one: no label was ever compared with them."""
    urls = [f"http://even.com/s{i % 120}/p{i}" for i in range(6000)] + [f"http://even.com/de/p{i}" for i in range(50)]
    got = verdicts(spark, urls)
    assert Counter(r.verdict for r in got.values()) == {"allow": 6000, "block": 50}
    assert len({r.template for r in got.values()}) == 121


def test_sections_count_by_their_own_urls(spark):
    """A small section of a large host keeps its literal, whatever the host's size."""
    urls = [f"http://big.com/fr/p{i}" for i in range(4000)] + [f"http://big.com/de/x{i}" for i in range(8)] + [f"http://big.com/news/n{i}" for i in range(8)]
    got = verdicts(spark, urls)
    assert {r.template for r in got.values()} == {"/fr/*", "/de/*", "/news/*"}


def test_z_test_merges_like_branches_on_two_levels(spark):
    """Alike branches with labels merge, then their node with its alike siblings; a different one stays apart."""
    urls = [f"http://deep.com/de/{a}/{b}/{a}{b}{i}" for a in ("x", "y") for b in ("u", "v") for i in range(9)]
    urls += [f"http://deep.com/fr/x/u/p{i}" for i in range(9)]
    got = verdicts(spark, urls)
    assert {r.template for r in got.values()} == {"/de/*/*/*", "/fr/x/u/*"}
    assert {(r.template, r.verdict) for r in got.values()} == {("/de/*/*/*", "block"), ("/fr/x/u/*", "allow")}


def test_url_edges(spark):
    """Null ids, repeated rows, clashing columns and a very long url."""
    long = "http://h.com/" + "/".join(f"s{i}" for i in range(2000))
    rows = [(None, long, "a", 1), (None, long, "b", 2), (1, None, None, None), (2, "", "c", 3)]
    out = judge(spark.createDataFrame(rows, "page_id long, url string, host string, labelled int"), queries.RULES).collect()
    assert Counter((r.page_id, r.host, r.verdict) for r in out) == {(None, "h.com", "allow"): 2, (1, "", "allow"): 1, (2, "", "allow"): 1}
