import pytest
from pyspark.sql import functions as F

from enrichkit.operators.keyed import keep_last
from enrichkit.session import scratch_path
from enrichkit.sinks import create_table_as, keyed_overwrite, write_csv, write_documents, write_text
from enrichkit.sources import read_csv, read_documents, read_table
from tests.conftest import rows

PAIRS = [("oak", 11), ("ash", 12), ("elm", 13), ("fir", 14)]


def test_csv_round_trip_keeps_names_and_types(spark):
    df = spark.createDataFrame(PAIRS, "word string, n bigint")
    path = scratch_path(spark, "pairs")
    write_csv(df, path)
    with pytest.raises(Exception):
        write_csv(df, path)  # the path exists: fail, as by default
    assert rows(read_csv(spark, path)) == sorted((w, str(n)) for w, n in PAIRS)  # untyped: text
    back = read_csv(spark, path, schema=df.schema)
    assert back.dtypes == df.dtypes and rows(back) == sorted(PAIRS)
    named = read_csv(spark, path, names=["w", "k"])
    assert named.columns == ["w", "k"]


def test_csv_keeps_hard_texts(spark):
    texts = [None, "", " outer blanks ", 'O\'Hara, "Nell"', '""', "back\\slash", "two\nlines", "a\r\nb", "\\N", ","]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    path = scratch_path(spark, "hard")
    write_csv(df, path, multiline=True)
    back = read_csv(spark, path, schema=df.schema, multiline=True, options={"lineSep": "\n"})
    assert dict(rows(back)) == dict(enumerate(texts))
    with pytest.raises(Exception, match="multiline"):
        write_csv(df, scratch_path(spark, "hard"))
    plain = df.where(~F.coalesce(F.col("v").rlike("[\r\n]"), F.lit(False)))
    path = scratch_path(spark, "hard")
    write_csv(plain, path)
    assert dict(rows(read_csv(spark, path, schema=df.schema))) == dict(rows(plain))


def test_header_lowercase(spark):
    df = spark.createDataFrame([(1, "x")], "RecordId int, Name string")
    path = scratch_path(spark, "records")
    write_csv(df, path, header=True)
    back = read_csv(spark, path, header=True, lowercase_columns=True)
    assert back.columns == ["recordid", "name"] and rows(back) == [("1", "x")]


def test_text_dump(spark):
    df = spark.createDataFrame([("7", "plum", "id-5"), ("8", "fig", None)], "id string, pid string, deid string")
    path = scratch_path(spark, "sample_deid")
    write_text(df, path)
    assert rows(spark.read.text(path)) == [("[7,plum,id-5]",), ("[8,fig,null]",)]


def test_keyed_overwrite_keeps_last(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (1, 0, "z")], "recordid int, seq int, v string")
    path = scratch_path(spark, "index")
    keyed_overwrite(df, path, "recordid", ["seq"])
    keyed_overwrite(df.where(F.col("recordid") == 2), path, "recordid", ["seq"])  # drop and recreate
    assert rows(spark.read.parquet(path)) == [(2, 1, "c")]
    assert rows(keep_last(df, "recordid", ["seq"])) == [(1, 2, "b"), (2, 1, "c")]


def test_documents_round_trip(spark):
    df = spark.createDataFrame([("k", "1", 2)], "field string, val string, count bigint")
    path = scratch_path(spark, "value_counts_index")
    write_documents(df, path)
    write_documents(df, path)  # append, as a second run adds the counts again
    back = read_documents(spark, path, schema=df.schema)
    assert rows(back) == [("k", "1", 2), ("k", "1", 2)]


def test_create_table_as_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("k"))
    name = "ctas_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    out = create_table_as(df, name, limit=10, order_by=["k"], path=scratch_path(spark, name))
    assert rows(out) == [(i,) for i in range(10)]
    assert rows(read_table(spark, name)) == [(i,) for i in range(10)]
    assert create_table_as(df, name + "_u", limit=10, path=scratch_path(spark, name + "_u")).count() == 10


def test_keep_last_ties_are_repeatable(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 5, "c"), (2, 1, "x")], "k int, seq int, v string")
    assert rows(keep_last(df.repartition(3), "k", ["seq"])) == [(1, 5, "c"), (2, 1, "x")]


def test_documents_missing_fields_read_as_null(spark):
    path = scratch_path(spark, "docs")
    spark.createDataFrame([('{"recordid": "1", "name": "a"}',), ('{"recordid": "2"}',)], "value string").write.text(path)
    docs = read_documents(spark, path, schema="recordid string, name string, age string")
    assert rows(docs) == [("1", "a", None), ("2", None, None)]


def test_header_scan_and_text_dump_grow_with_their_table():
    import __spark_entry__ as entry

    for name in ("orders_csv_header_scan", "orders_text_dump"):
        assert name in entry.queries() and "FROM orders" in entry.oracle_sql()[name]
