from datetime import date

import pytest

from accountwise.sources import manifest, readers, writers
from accountwise.sources.schemas import RAW


def test_identifiers():
    assert readers.safe_identifier(" RAW ", ["raw"]) == "raw"
    for bad in ("raw; drop", "1x", "a-b", "", "other"):
        with pytest.raises(ValueError):
            readers.safe_identifier(bad, ["raw"])


def test_bulk_load_quarantines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "SEVERITY,ticket_id,account_id,created_date,resolved_date,category,resolution_hours\n"
        'P1,t1,A,2022-01-01 10:00:00,,"Bill, ing",1.5\n'
        "P2,t2,A,2022-01-02,None,x,NaT\n"
        "P3,t3,A,not a date,,x,2\n"
        "P4,t4,A,2022-01-03\n"
    )
    load = readers.bulk_load_raw(spark, str(path), readers.schema_of(RAW["support_tickets"]))
    good = {r["ticket_id"]: r for r in load.good.collect()}
    assert set(good) == {"t1", "t2"} and good["t1"]["category"] == "Bill, ing" and good["t1"]["severity"] == "P1"
    assert good["t2"]["resolved_date"] is None and good["t2"]["resolution_hours"] is None
    assert sorted(r["reason"] for r in load.rejected.collect()) == ["created_date", "wrong number of cells"]
    assert tuple(load.counts.first()) == (2, 2)


@pytest.mark.parametrize("size", ["128m", "40b", "7b"])
def test_quoted_line_breaks_on_blocks_of_any_size(spark, tmp_path, size):
    import csv

    cells = ["plain", "two\nlines", 'a "quoted" word\nand more\n\nend', "", "x" * 30 + "\n" + "y" * 30, "comma, semi", "last\n"]
    for part in range(2):
        with open(tmp_path / f"p{part}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\n" if part else "\r\n", quoting=csv.QUOTE_MINIMAL)
            out.writerow(["traveler_id", "account_id", "role", "travel_tier"])
            out.writerows([f"{part}-{k}", "A", cells[k % 7], "z"] for k in range(23))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        load = readers.bulk_load_raw(spark, str(tmp_path), readers.schema_of(RAW["traveler_profiles"]))
        got = {r["traveler_id"]: r["role"] for r in load.good.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"{p}-{k}": cells[k % 7] or None for p in range(2) for k in range(23)}
    assert tuple(load.counts.first()) == (46, 0) and load.rejected.isEmpty()


def test_files_with_another_header_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("traveler_id,account_id,role,travel_tier\nt,A,r,z\n")
    (tmp_path / "b.csv").write_text("account_id,traveler_id,role,travel_tier\nA,t,r,z\n")
    with pytest.raises(Exception, match="another header"):
        readers.bulk_load_raw(spark, str(tmp_path), readers.schema_of(RAW["traveler_profiles"]))


def test_parquet_before_csv_and_missing(spark, tmp_path):
    df = spark.createDataFrame([("A", "T", "r", "x")], "account_id string, traveler_id string, role string, travel_tier string")
    folder = str(tmp_path)
    df.write.csv(f"{folder}/traveler_profiles.csv", header=True)
    assert readers.read_files(spark, folder, "traveler_profiles").first()["traveler_id"] == "T"
    df.limit(0).write.parquet(f"{folder}/traveler_profiles.parquet")
    assert readers.read_files(spark, folder, "traveler_profiles").count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_files(spark, folder, "bookings")
    assert readers.load_tables(spark, folder, names=("traveler_profiles", "clv_labels"), optional=("clv_labels",)).keys() == {"travelers"}


def test_bad_dates_become_null(spark, tmp_path):
    (tmp_path / "service_contracts.csv").write_text(
        "contract_id,account_id,product,start_date,end_date,contract_value,is_active\n"
        "c,A,Neo,2022-01-01 00:00:00,garbage,10.5,True\n"
    )
    row = readers.read_files(spark, str(tmp_path), "service_contracts").first()
    assert row["start_date"] == date(2022, 1, 1) and row["end_date"] is None and row["is_active"] is True


def test_manifest_fails_closed(spark, tmp_path):
    a, b = tmp_path / "a.json", tmp_path / "sub"
    b.mkdir()
    a.write_text("{}")
    (b / "c.csv").write_text("x")
    (b / "note.txt").write_text("ignored")
    before = spark.createDataFrame(manifest.manifest(spark, str(tmp_path)).collect(), "path string, bytes bigint, sha256 string")
    assert {r["path"] for r in before.collect()} == {"a.json", "sub/c.csv"}
    manifest.require_intact(before, manifest.manifest(spark, str(tmp_path)))
    # the same hashes from one-byte chunks, also of names that need escapes in a URI
    (tmp_path / "a b#.json").write_text("odd name")
    in_chunks = manifest.manifest(spark, str(tmp_path), chunk=1)
    assert sorted(in_chunks.collect()) == sorted(manifest.manifest(spark, str(tmp_path)).collect())
    (tmp_path / "a b#.json").unlink()
    a.write_text("[]")
    (b / "new.csv").write_text("y")
    got = {r["path"]: r["status"] for r in manifest.verify(before, manifest.manifest(spark, str(tmp_path))).collect()}
    assert got == {"a.json": "changed", "sub/c.csv": "ok", "sub/new.csv": "new"}
    with pytest.raises(RuntimeError):
        manifest.require_intact(before, manifest.manifest(spark, str(tmp_path)))


def test_feature_sink_rejects_unknown_format(spark, tmp_path):
    df = spark.createDataFrame([("A", "EMEA", 1)], "account_id string, region string, n int")
    paths = writers.write_features(df, str(tmp_path), "both", partition_by="region")
    assert spark.read.parquet(paths[0]).count() == 1 and spark.read.csv(paths[1], header=True).count() == 1
    with pytest.raises(ValueError):
        writers.write_features(df, str(tmp_path), "xml")


def test_bucketed_tables_join_without_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketing")
    df = spark.range(1000).selectExpr("id account_id", "id % 7 v")
    for t in ("l", "r"):
        writers.save_bucketed(df, f"bucketing.{t}", "account_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketing.l").join(spark.table("bucketing.r"), "account_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000 and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketing CASCADE")


def test_manifest_query_on_tables_in_folders(spark, tmp_path):
    """Tables of several files are compared as tables."""
    from accountwise.plans.registry import Bound, s10_manifest

    for name in ("region", "part", "nation"):
        spark.range(30).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["path"]: r["status"] for r in s10_manifest(Bound(spark, str(tmp_path))).collect()}
    assert got == {"region.parquet": "changed", "part.parquet": "new", "gone.parquet": "missing", "nation.parquet": "ok"}


def test_pages_of_many_ranges_are_few_files(spark, tmp_path, monkeypatch):
    """Ranges of three rows: files and tasks follow the rows, and every page is that of an offset."""
    from pyspark.sql import functions as F

    from accountwise.operators import lookups
    from accountwise.sources import writers

    monkeypatch.setattr(writers, "ROWS_PER_FILE", 100)
    extra = {c: F.lit(1.0) for c in ("clv_12m", "booking_count_90d", "total_spend_90d", "num_active_products")}
    rows = spark.range(0, 600, 2).select(
        F.col("id").alias("account_id"), F.element_at(F.array(F.lit("Gold"), F.lit("Silver"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("tier"),
        F.lit("EU").alias("region"), F.lit("Retail").alias("industry"), F.lit(False).alias("is_churned"), F.lit("a").alias("segment")).withColumns(extra)
    path = writers.write_pages(rows, str(tmp_path / "pages"), rows_per_range=3)
    assert len(list((tmp_path / "pages" / "rows").glob("page_file=*"))) <= 3
    assert spark.read.parquet(f"{path}/index").select("page_range").distinct().count() >= 100
    for after in (None, 0, 101, 396, 598):
        for tier in (None, "Gold"):
            want = [k for k in range(0, 600, 2) if (after is None or k > after) and (tier is None or k % 3 == 0)][:50]
            page = lookups.page_after(spark, path, after=after, tier=tier).collect()
            assert [r["account_id"] for r in page] == want and all(r["total"] == (100 if tier else 300) for r in page)
