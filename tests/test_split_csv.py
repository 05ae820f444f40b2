"""CSV with quoted line breaks in many tasks against Python's csv module and the sequential reader."""

import csv
import os
import random

import pytest

from enrichkit.session import scratch_path
from enrichkit.sinks import write_csv
from enrichkit.sources import read_csv, read_split_csv
from tests.conftest import ORACLE_SF, rows


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def made_rows(seed, n):
    pick = random.Random(seed)
    bits = ["\n", '"', ",", "a", "bc ", "ä", "\r\n", '""', "\\", "\n\n", "x" * 40]
    made = [(str(i), "".join(pick.choices(bits, k=pick.randrange(12)))) for i in range(n)]
    made[n // 2] = (str(n // 2), 'long "text",\n' * 300)  # longer than several splits
    made[3] = ("3", "no break " * 300)  # a line longer than several splits
    return made


def written(path, made, header=False, line_end="\n"):
    os.makedirs(path, exist_ok=True)
    for k in range(2):
        with open(f"{path}/part-{k}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator=line_end)
            if header:
                out.writerow(["id", "a\nname"])
            out.writerows(made[k::2])


@pytest.mark.parametrize("header", [False, True])
@pytest.mark.parametrize("most", [None, -1])
def test_equals_csv_module(spark, small_splits, tmp_path, header, most):
    made = made_rows(7, 400)
    written(str(tmp_path), made, header)
    back = read_split_csv(spark, str(tmp_path), schema="id string, v string", header=header, max_broadcast_bytes=most)
    assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 10
    assert rows(back) == sorted(made)


def test_cr_lf_and_names(spark, small_splits, tmp_path):
    made = [(i, v.replace("\r\n", "\n")) for i, v in made_rows(8, 100)]
    written(str(tmp_path), made, header=True, line_end="\r\n")
    back = read_split_csv(spark, str(tmp_path), header=True, line_end="\r\n")
    assert back.columns == ["id", "a\nname"] and rows(back) == sorted(made)


def test_hard_texts_as_the_sequential_reader(spark, small_splits):
    texts = [None, "", " outer blanks ", 'O\'Hara, "Nell"', '""', "back\\slash", "two\nlines", "a\r\nb", "\\N", ",", "\n", "x\n" * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    path = scratch_path(spark, "hard")
    write_csv(df, path, multiline=True)
    back = read_split_csv(spark, path, schema=df.schema)
    assert back.dtypes == df.dtypes and dict(rows(back)) == dict(enumerate(texts))


def test_documents_in_many_splits(spark, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    docs = spark.read.parquet(f"{ORACLE_SF}/documents.parquet").coalesce(1)
    path = scratch_path(spark, "documents")
    write_csv(docs, path, multiline=True)
    back = read_split_csv(spark, path, schema=docs.schema)
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    assert back.exceptAll(docs).isEmpty() and docs.exceptAll(back).isEmpty()


def test_unclosed_quote_blank_records_and_no_rows(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('1,a\n\n2,"b\nc"\n3,"open\n4,d\n')
    back = read_split_csv(spark, str(tmp_path / "a.csv"), schema="id int, v string")
    assert sorted(r.id for r in back.collect()) == [1, 2, 3]
    (tmp_path / "e.csv").write_text("")
    assert read_split_csv(spark, str(tmp_path / "e.csv"), schema="id int, v string").count() == 0
    (tmp_path / "h.csv").write_text("id,v\n")
    assert read_split_csv(spark, str(tmp_path / "h.csv"), schema="id int, v string", header=True).count() == 0


def test_one_split_equals_the_sequential_reader(spark, tmp_path):
    written(str(tmp_path), made_rows(9, 50))
    back = read_split_csv(spark, str(tmp_path), schema="id string, v string")
    whole = read_csv(spark, str(tmp_path), schema="id string, v string", multiline=True, options={"lineSep": "\n"})
    assert rows(back) == rows(whole)
