from enrichkit.plans.jobs import load_keyed_index, report_table
from enrichkit.session import scratch_path
from enrichkit.sinks import write_csv
from tests.conftest import rows


def test_load_keyed_index_keeps_last_row_in_file_order(spark):
    df = spark.createDataFrame(
        [("1", "a"), ("2", "b"), ("1", "c"), ("3", "d"), ("1", "e")], "RecordId string, Name string"
    )
    csv = scratch_path(spark, "train_csv")
    write_csv(df.coalesce(1), csv, header=True)
    target = scratch_path(spark, "record_index")
    check = load_keyed_index(spark, csv, target, "recordid")
    assert check.count() == 2
    assert rows(spark.read.parquet(target)) == [("1", "e"), ("2", "b"), ("3", "d")]


def test_report_table(spark):
    spark.range(0, 100).createOrReplaceTempView("source_events")
    name = "report_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    out = report_table(spark, "source_events", name, limit=10, order_by=["id"], path=scratch_path(spark, name))
    assert rows(out) == [(i,) for i in range(10)]


def test_dns_alert_job_over_files(spark):
    from pyspark.sql import functions as F

    from enrichkit.operators.blocklist import dns_alerts
    from enrichkit.plans import fixtures as fx
    from enrichkit.plans.jobs import dns_alert_job
    from enrichkit.streaming import alert_values
    from tests.conftest import SMALL

    root = scratch_path(spark, "dns_job")
    # messages carry only the DNS line, as the reference's records do
    fx.dns_messages(spark, SMALL).select(F.to_json(F.struct("message")).alias("value")).write.text(f"{root}/in")
    write_csv(fx.domain_list(spark, SMALL), f"{root}/list")
    q = dns_alert_job(
        spark, list_path=f"{root}/list", checkpoint_location=f"{root}/ckpt",
        source_format="text", source_path=f"{root}/in", sink_format="text", sink_path=f"{root}/out",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    got = sorted(r[0] for r in spark.read.text(f"{root}/out").collect())
    expected = alert_values(dns_alerts(fx.dns_messages(spark, SMALL).select("message"), fx.domain_list(spark, SMALL)))
    assert got == sorted(r[0] for r in expected.collect()) and len(got) > 0


def test_load_keyed_index_goes_by_file_and_place(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "part-0.csv").write_text("Key,V\na,first\nb,small\n")
    (folder / "part-1.csv").write_text("Key,V\n" + "".join(f"k{i},{i}\n" for i in range(2000)) + "a,last\n")
    target = str(tmp_path / "store")
    load_keyed_index(spark, str(folder), target, "key")
    stored = {r.key: r.v for r in spark.read.parquet(target).collect()}
    assert spark.read.parquet(target).columns == ["key", "v"]
    assert stored["a"] == "last" and stored["b"] == "small" and len(stored) == 2002


def test_load_keyed_index_reads_multiline_files_by_splits(spark, tmp_path):
    """Each file was one task's; the last row in file order stays, wherever the splits are cut."""
    folder = tmp_path / "in"
    folder.mkdir()
    texts = [f'"say ""{i}"",\n\n twice "' if i % 3 else str(i) for i in range(400)]
    (folder / "part-0.csv").write_text("Key,Note\n" + "".join(f"k{i % 37},{t}\n" for i, t in enumerate(texts)))
    (folder / "part-1.csv").write_text("Key,Note\n" + "".join(f"k{i % 11 + 30},{t}x\n" for i, t in enumerate(texts) if not i % 3))
    want = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    stored, plain = str(tmp_path / "store"), str(tmp_path / "plain")
    load_keyed_index(spark, str(folder), plain, "key", multiline=True)
    for size in (50, 700, 10**8):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            load_keyed_index(spark, str(folder), stored, "key", multiline=True, line_end="\n")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", want[0])
            spark.conf.set("spark.sql.files.openCostInBytes", want[1])
        assert rows(spark.read.parquet(stored)) == rows(spark.read.parquet(plain))
