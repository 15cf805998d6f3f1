"""Typed table reads and writes.

CSV is the exchange format of the jobs' users; between our own jobs use
Parquet, which prunes columns and splits for any number of executors.  The raw
export, which may be one large file with line breaks inside quotes, is read by
byte ranges (csv_ranges); the small exchange tables are read a task per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.session import materialize
from caseloom.sources.csv_ranges import infer_types, scan_csv_ranges


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _STR, _BOOL, _INT = T.LongType(), T.StringType(), T.BooleanType(), T.IntegerType()

RAW_POSTS = _table(tweet_id=_LONG, author_id=_STR, inbound=_BOOL, text=_STR,
                   in_response_to_tweet_id=_LONG)
PAIRS = _table(customer_tweet_id=_LONG, customer_text=_STR, apple_tweet_id=_LONG,
               apple_reply_text=_STR, is_dm_redirect=_BOOL, thread_depth=_LONG)
EXCLUDED_IDS = _table(customer_tweet_id=_LONG)
GOLDEN_FINAL = _table(customer_tweet_id=_LONG, customer_text=_STR, apple_reply_text=_STR,
                      is_dm_redirect=_BOOL, true_intent=_STR, true_routing=_STR,
                      escalation_reason=_STR)
OVERRIDES = _table(customer_tweet_id=_LONG, true_intent=_STR, true_routing=_STR,
                   escalation_reason=_STR)
RUN_OUTPUT = T.StructType(GOLDEN_FINAL.fields + _table(
    predicted_intent=_STR, routing_decision=_STR, escalation_reason_predicted=_STR,
    drafted_reply=_STR, retrieved_precedent=_STR).fields)
JUDGE_SCORES = T.StructType(RUN_OUTPUT.fields + _table(
    judge_relevance=_INT, judge_groundedness=_INT, judge_tone=_INT).fields)
HUMAN_SCORES = _table(customer_tweet_id=_LONG, human_relevance=_INT,
                      human_groundedness=_INT, human_tone=_INT)
RESPONSE_CACHE = _table(key=_STR, response=_STR, written_at=T.TimestampType())

# Doubled quotes inside fields; "" stays an empty string, nothing at all is null.
_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
        "nullValue": "\u0000", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A short list of rows as part of the plan, with a size the planner knows."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select([rows[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def scan_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   multi_line: bool = True) -> DataFrame:
    """Typed CSV read; columns are matched by name, undecodable bytes become U+FFFD."""
    return _typed(spark.read.options(**{**_CSV, "multiLine": str(multi_line).lower()}).csv(path), schema)


def scan_raw_posts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The raw export; of its columns only the five that are used.

    Many tasks share a file either way; multi_line=False, for exports without line
    breaks inside quotes, saves the pass that counts quotes.
    """
    if not multi_line:
        return scan_csv_table(spark, path, RAW_POSTS, False)
    return _typed(scan_csv_ranges(spark, path, _CSV), RAW_POSTS)


def scan_inferred(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV of any size with the types that all their values have."""
    rows = materialize(scan_csv_ranges(spark, path, _CSV), "csv")
    return _typed(rows, infer_types(rows))


def scan_optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows where there is none yet."""
    try:
        return scan_csv_table(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Written quotes keep "" (empty) apart from nothing (null).
        writer.options(**{**_CSV, "nullValue": "", "emptyValue": '""'}).csv(path)
    else:
        writer.format(fmt).save(path)
