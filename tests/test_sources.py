import random

import pytest
from pyspark.sql import functions as F

from caseloom.operators.latent import embed_text
from caseloom.plans.prepare import build_index
from caseloom.session import materialize, scratch_path
from caseloom.sources import csv_ranges
from caseloom.sources import retrieval_store as store
from caseloom.sources import tables as t


def test_raw_csv_with_bad_bytes_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(b'tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n'
                     b'1,u1,True,Tue,"caf\xe9 ""here""\nand there",2,\n'
                     b'2,Acme,False,Tue,plain,,1\n')
    rows = t.scan_raw_posts(spark, str(path)).orderBy("tweet_id").collect()
    assert tuple(rows[0]) == (1, "u1", True, 'caf� "here"\nand there', None)
    assert tuple(rows[1]) == (2, "Acme", False, "plain", 1)


def test_csv_keeps_empty_apart_from_null(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, "", None), (3, None, ' "x", \n y '), (4, "\\", "\\n")],
                               "id long, a string, b string")
    path = scratch_path(spark, "csv")
    t.write_table(df, path, "csv")
    assert t.scan_csv_table(spark, path, df.schema).orderBy("id").collect() == df.orderBy("id").collect()


def test_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text("human_tone,customer_tweet_id,extra,human_relevance,human_groundedness\n5,17,x,4,oops\n")
    assert tuple(t.scan_csv_table(spark, str(path), t.HUMAN_SCORES).first()) == (17, 4, None, 5)


def test_optional_table(spark, tmp_path):
    missing = t.scan_optional_table(spark, str(tmp_path / "none.csv"), t.EXCLUDED_IDS)
    assert missing.count() == 0 and missing.schema == t.EXCLUDED_IDS
    (tmp_path / "ids.csv").write_text("customer_tweet_id\n7\n")
    assert t.scan_optional_table(spark, str(tmp_path / "ids.csv"), t.EXCLUDED_IDS).first()[0] == 7


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_write_replaces(spark, fmt):
    path = scratch_path(spark, "table")
    t.write_table(spark.range(5), path, fmt)
    t.write_table(spark.range(3), path, fmt)
    read = spark.read.option("header", "true").format(fmt).load(path)
    assert read.count() == 3


def test_index_leaves_the_golden_rows_out(spark):
    pairs = spark.range(20).select(
        F.col("id").alias("customer_tweet_id"), F.concat(F.lit("text "), "id").alias("customer_text"),
        F.lit("reply").alias("apple_reply_text"), F.lit(None).cast("boolean").alias("is_dm_redirect"),
        F.lit(1).cast("bigint").alias("thread_depth"))
    path = scratch_path(spark, "index")
    for _ in range(2):  # a rebuild does not add
        build_index(pairs, spark.range(5).toDF("customer_tweet_id"), lambda df: embed_text(df, "customer_text", 32), path)
    index = store.load_retrieval_table(spark, path)
    assert store.count_entries(index).first().entries == 15
    assert index.where("customer_tweet_id < 5").count() == 0 and index.where("is_dm_redirect").count() == 0


def test_materialized_table_is_read_back_in_full(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    assert sorted(materialize(df, "t").collect()) == sorted(df.collect())


# ---- byte ranges

@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that small files have many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("300b", "0b")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def wild_csv(rng, rows, ends="\n"):
    """A CSV whose quoted fields hold line breaks, commas, quotes, empty lines and nothing."""
    pieces = ["plain", "", '""', "a\nb", "\n", "\n\n", ",", '""x""', "é日本", "z" * 700, "l\n" * 60, " ", "\r\n"]
    lines = ["id,text,other"]
    for i in range(rows):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(4)))
        quoted = f'"{text}"' if rng.random() < 0.7 or set(text) & set('",\n\r') else text
        lines.append(f'{i},{quoted},"{rng.choice(["", "o", "p" + chr(10) + "q"])}"')
    return (ends.join(lines) + ends).replace("\r\r", "\r").encode()


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_ranges_give_the_rows_of_a_whole_read(spark, tmp_path, small_ranges, ends):
    rng = random.Random(11)
    for i, n in enumerate((400, 1, 0)):
        (tmp_path / f"{i}.csv").write_bytes(wild_csv(rng, n, ends) + (b"\n\n" if i == 0 else b""))
    got = csv_ranges.scan_csv_ranges(spark, str(tmp_path), t._CSV)
    want = spark.read.options(**{**t._CSV, "multiLine": "true"}).csv(str(tmp_path))
    assert got.columns == want.columns and want.count() == 401
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "one.csv").write_bytes(wild_csv(random.Random(12), 300))
    rows = csv_ranges.records(spark, str(tmp_path))
    assert csv_ranges._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows.select("start").distinct().count() > 20


def test_a_record_longer_than_many_ranges(spark, tmp_path, small_ranges):
    body = "line\n" * 1_000
    (tmp_path / "long.csv").write_text(f'tweet_id,text,author_id,inbound,in_response_to_tweet_id\n1,"{body}",a,true,\n2,short,b,false,1\n')
    rows = t.scan_raw_posts(spark, str(tmp_path / "long.csv")).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.text, r.in_response_to_tweet_id) for r in rows] == [(1, body, None), (2, "short", 1)]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c,d,e,f\n1,1.5,true,2024-01-02 03:04:05,x,\n2,2,False,2024-01-03,"1\n2",\n,,,,,\n')
    read = t.scan_inferred(spark, str(tmp_path / "x.csv"))
    assert [f.dataType.simpleString() for f in read.schema.fields] == ["bigint", "double", "boolean", "timestamp", "string", "string"]
    assert read.where("a = 2").first().e == "1\n2" and read.count() == 3
