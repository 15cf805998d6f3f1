"""Reading CSV with line breaks inside quotes, many tasks to a file.

Whether a place in a file is inside quotes depends on everything before it, but
only through the parity of the quotes there.  A first pass counts quotes per byte
range (the scan's own splits); a running sum over the ranges of a file tells each
range whether it starts inside quotes.  A second pass cuts each range into records
from its own lines.  Records that cross a range's end come out as fragments, at
most two a range, and are put together by a small join.

Quotes are doubled inside quoted fields, and a field that holds a quote is quoted,
as RFC 4180 has it; a lone quote inside an unquoted field would mislead the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.session import materialize


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the range they were read from, in the order of the range."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), F.make_valid_utf8("value").alias("line"))


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether a range starts inside quotes.  One row per range."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


class _Cutter:
    """Cuts the lines of one range into records, batch by batch."""

    def __init__(self, file: str, start: int, inside: int):
        self.name, self.inside, self.held = (file, start), inside, []
        self.fragment = inside == 1  # the lines held belong to a record of an earlier range
        self.header = start == 0  # the file's first record is still to come

    def feed(self, lines: pa.Array) -> list[tuple[str, str]]:
        """(kind, text) of what is complete."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
        after = (self.inside + np.cumsum(odd)) % 2  # whether a line ends inside quotes
        texts, low, out = lines.to_pylist(), 0, []
        for end in np.flatnonzero(after == 0).tolist():
            text = "\n".join([*self.held, *texts[low: end + 1]]) if self.held or end > low else texts[low]
            self.held, low = [], end + 1
            if self.fragment:
                out.append(("tail", text))
                self.fragment = False
            elif text not in ("", "\r"):
                out.append(("header" if self.header else "record", text))
                self.header = False
        self.held += texts[low:]
        if len(after):
            self.inside = int(after[-1])
        return out

    def rest(self) -> list[tuple[str, str]]:
        """What the range ends in the middle of."""
        if not self.held:
            return []
        return [("middle" if self.fragment else "header head" if self.header else "head", "\n".join(self.held))]


def _cutting(states):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, cutter = states.value, None

        def out(found: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
            if found:
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([cutter.name[0]] * n, pa.string()), pa.array([cutter.name[1]] * n, pa.int64()),
                                                  pa.array([k for k, _ in found], pa.string()), pa.array([t for _, t in found], pa.string())],
                                                 ["file", "start", "kind", "text"])

        for batch in batches:
            if not batch.num_rows:
                continue
            file, start = pc.dictionary_encode(batch.column("file")), batch.column("start").to_numpy()
            codes = file.indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (start[1:] != start[:-1])]).tolist()
            for low, high in zip(cuts, [*cuts[1:], batch.num_rows]):
                own = (batch.column("file")[low].as_py(), int(start[low]))
                if cutter is None or own != cutter.name:
                    if cutter is not None:
                        yield from out(cutter.rest())
                    cutter = _Cutter(*own, inside.get(own, 0))
                yield from out(cutter.feed(batch.column("line").slice(low, high - low)))
        if cutter is not None:
            yield from out(cutter.rest())

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, text) of every record of the files but their headers, line breaks inside quotes kept.

    start: the range a record begins in.  Empty lines outside quotes are no records.  One
    row per range reaches the driver.
    """
    lines = _lines(spark, path)
    states = {(r["file"], r["start"]): r["inside"] for r in _ranges(lines).collect()}
    cut = materialize(lines.mapInArrow(_cutting(spark.sparkContext.broadcast(states)), "file string, start bigint, kind string, text string"), "records")
    # a range's tail stands before its head
    fragments = cut.where("kind not in ('record', 'header')").withColumn("at", F.when(F.col("kind").endswith("head"), 1).otherwise(0))
    numbered = fragments.withColumn("n", F.sum("at").over(Window.partitionBy("file").orderBy("start", "at")))
    joined = numbered.groupBy("file", "n").agg(F.min("start").alias("start"), F.bool_or(F.col("kind") == "header head").alias("header"),
                                              F.array_sort(F.collect_list(F.struct("start", "at", "text"))).alias("parts"))
    whole = joined.where("not header").select("file", "start", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    every = cut.where("kind = 'record'").select("file", "start", "text").unionByName(whole)
    # a record that ends in \r\n has line breaks of two characters, which are read as one
    unix = F.regexp_replace(F.regexp_replace("text", "\\r\\n", "\n"), "\\r$", "")
    return every.withColumn("text", F.when(F.endswith("text", F.lit("\r")), unix).otherwise(F.col("text"))).where("text <> ''")


def scan_csv_ranges(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """All columns as strings; every file has the same header, which is left out."""
    names = spark.read.options(**{**options, "multiLine": "true"}).csv(path).columns
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("text", ddl, {k: v for k, v in options.items() if k not in ("header", "encoding")})
    return records(spark, path).select(parsed.alias("r")).select("r.*")


#: Types a column may turn out to have, the narrowest first.
KINDS = ("bigint", "double", "boolean", "timestamp")


def infer_types(rows: DataFrame) -> T.StructType:
    """The narrowest type that every value of a string column has, over all rows in one pass; string where none has.

    Each task keeps a few flags per column, which are merged; empty strings count as null.
    """
    def fits(column: Column, kind: str) -> Column:
        value = F.when(column != "", column)
        return F.coalesce(F.bool_and(value.isNull() | value.try_cast(kind).isNotNull()), F.lit(True))

    flags = rows.agg(*[fits(F.col(f"`{c}`"), k).alias(f"{i}_{k}") for i, c in enumerate(rows.columns) for k in KINDS],
                     *[F.count(F.when(F.col(f"`{c}`") != "", 1)).alias(f"{i}_n") for i, c in enumerate(rows.columns)]).first()
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    chosen = [next((kinds[k] for k in KINDS if flags[f"{i}_{k}"] and flags[f"{i}_n"]), T.StringType()) for i in range(len(rows.columns))]
    return T.StructType([T.StructField(c, t) for c, t in zip(rows.columns, chosen)])
