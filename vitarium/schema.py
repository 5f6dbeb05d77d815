"""Schemas of the tables that flow between jobs.

NULL means "this row says nothing about the column"; the empty string means
"the column is present and empty".  Merges treat the two differently.
"""

from __future__ import annotations

from pyspark.sql import types as T

from vitarium.fixed import RECORD_COLUMNS

#: Durable position of a row in the record log, most significant first: listing
#: rows (stage 0) come before detail rows (stage 1), then the micro-batch or run,
#: then the captured page, then the place on that page.
LOG_ORDER = ["stage", "batch_id", "page_seq", "card_pos"]
LISTING_STAGE, DETAIL_STAGE = 0, 1

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_COLUMNS])

PAGES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("page_seq", T.LongType()),
    ]
)

LOG = T.StructType(
    [T.StructField(c, T.StringType()) for c in RECORD_COLUMNS]
    + [
        T.StructField("record_key", T.StringType()),
        T.StructField("page_seq", T.LongType()),
        T.StructField("card_pos", T.IntegerType()),
        T.StructField("stage", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

LISTING_STATE = T.StructType(
    [
        T.StructField("index_url", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("html", T.StringType()),
        T.StructField("completed", T.BooleanType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("initial_index", T.IntegerType()),
        T.StructField("total_initials", T.IntegerType()),
    ]
)

SEEDS = T.StructType(
    [
        T.StructField("seed_pos", T.IntegerType()),
        T.StructField("qid", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
    ]
)
