"""DuckDB twins of the operators that SQL can state, straight from their contracts."""

from __future__ import annotations

from driftgate.llm.pivot_codes import ROUNDS

_NEAREST = """
near{r} AS (
  SELECT id, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist
  FROM (
    SELECT p.id, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
    FROM parts p JOIN book{r} b USING (part)
  ) GROUP BY id, part
)"""

_UPDATED = """
book{next} AS (
  SELECT part, b.entry, coalesce(m.v, b.v) AS v
  FROM book{r} b LEFT JOIN (
    SELECT part, entry, list(c ORDER BY place) AS v
    FROM (
      SELECT n.part, n.entry, place, floor_div(sum(p.v[place])::BIGINT, count(*)) AS c
      FROM near{r} n JOIN parts p USING (id, part) CROSS JOIN range(1, 1 + (SELECT d // 4 FROM dim)) t(place)
      GROUP BY n.part, n.entry, place
    ) GROUP BY part, entry
  ) m USING (part, entry)
)"""


def _op12() -> str:
    rounds = ",".join(_NEAREST.format(r=r) + "," + _UPDATED.format(r=r, next=r + 1) for r in range(ROUNDS))
    # sums over positive counts, rounded down
    rounds = rounds.replace("floor_div(sum(p.v[place])::BIGINT, count(*))", "((sum(p.v[place]) - (((sum(p.v[place]) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT")
    return f"""
WITH kept AS (
  SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), dim AS (SELECT max(len(x)) AS d FROM kept),
parts AS (
  SELECT id, part, x[1 + part * d // 4 : (part + 1) * d // 4] AS v
  FROM kept, dim, range(4) t(part)
),
book0 AS (
  SELECT part, (row_number() OVER (PARTITION BY part ORDER BY id) - 1)::BIGINT AS entry, v
  FROM parts QUALIFY entry < 256
),{rounds},{_NEAREST.format(r=ROUNDS)},
coded AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM near{ROUNDS} GROUP BY id
), flat AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS digest FROM book{ROUNDS}
), counted AS (
  SELECT id AS vec_id, code, error, label FROM coded JOIN kept USING (id)
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256
FROM counted, flat
"""


TWIN_OP12 = _op12()

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

TWIN_OP13 = f"""
WITH doc AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT doc_id, len(terms)::BIGINT AS n FROM doc WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM size),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM doc) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total GROUP BY term, big_n
),
asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), total
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
