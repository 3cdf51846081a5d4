"""Lineage columns: what the library and its sources add to rows, by name.

They are no business data: drift detection, row prints, NULL counts and
duplicates leave them out, and conforming keeps them.  The list is explicit; a
column of a dataset whose name merely starts with ``_`` is data like any other.
"""

from __future__ import annotations

BATCH_ID = "_batch_id"
RESCUED = "_rescued"
FAILED = "_failed_rules"
VALID = "_valid"
ROW_ID = "_rid"
ROW_PRINT = "_row_print"
NULL_CELLS = "_null_cells"
QUARANTINED_AT = "_quarantine_ts"
INGESTED_AT = "_ingest_ts"
SOURCE_LINE = ("_l_partkey", "_l_suppkey", "_l_shipdate", "_l_extendedprice", "_l_quantity")

LINEAGE = frozenset({BATCH_ID, RESCUED, FAILED, VALID, ROW_ID, ROW_PRINT, NULL_CELLS, QUARANTINED_AT, INGESTED_AT, *SOURCE_LINE})
