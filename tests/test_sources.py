import os

import pytest
from pyspark.sql import functions as F

from support import rows
from orelode import schemas
from orelode.plans import report
from orelode.sources import landing, scan, sinks, versions

HEADER = "InvoiceNo,ProductID,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def put(root, name, text, date="2026-01-01"):
    folder = root / f"ingestion_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_csv_scan(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER
        + '1,10,2,2026-01-05 10:00:00,3.5,7,"Korea, South"\n'
        + '2,10,,2026-01-05 10:00:00,3.5,"", France \n'
        + "3,10,2\n"
        + '4,10,2,31/02/2026,3.5,7,"say ""hi""",extra\n')
    put(tmp_path, "b.csv", HEADER + "5,11,1,,0,,usa\n", "2026-01-02")
    frame = scan.scan_orders_csv(spark, str(tmp_path))
    assert frame.columns == [*schemas.ORDERS_COLUMNS, "ingestion_date"]
    assert {kind for _, kind in frame.dtypes} == {"string"}
    assert rows(frame) == [
        ("1", "10", "2", "2026-01-05 10:00:00", "3.5", "7", "Korea, South", "2026-01-01"),
        ("2", "10", "", "2026-01-05 10:00:00", "3.5", "", " France ", "2026-01-01"),
        ("3", "10", "2", "", "", "", "", "2026-01-01"),
        ("4", "10", "2", "31/02/2026", "3.5", "7", 'say "hi"', "2026-01-01"),
        ("5", "11", "1", "", "0", "", "usa", "2026-01-02"),
    ]


def test_json_scan_of_products(spark, tmp_path):
    put(tmp_path, "p.jsonl", "\n".join([
        '{"id":1,"title":"A","tags":["x","y"],"dimensions":{"width":1.5},"brand":"B",'
        '"discountPercentage":5.0,"minimumOrderQuantity":2}',
        '{"id":2,"title":"C","discountpercentage":7.5}',
        "not json",
        "",
        '{"id":"three","title":"D"}',
    ]) + "\n")
    frame = scan.scan_products_json(spark, str(tmp_path))
    assert frame.columns == [*schemas.products_schema().names, "ingestion_date"]
    picked = frame.select(
        "id", "title", F.size("tags"), "dimensions.width", "brand", "discountpercentage",
        "minimumorderquantity", "ingestion_date",
    )
    assert rows(picked) == sorted([
        (1, "A", 2, 1.5, "B", 5.0, 2, "2026-01-01"),
        (2, "C", None, None, None, 7.5, None, "2026-01-01"),
        (None, None, None, None, None, None, None, "2026-01-01"),
        (None, "D", None, None, None, None, None, "2026-01-01"),
    ], key=repr)


def test_json_scan_of_users_in_both_key_styles(spark, tmp_path):
    put(tmp_path, "u.jsonl", "\n".join([
        '{"id":1,"firstName":"Ann","lastname":"Lee","address":{"stateCode":"CA",'
        '"postalcode":"94000","coordinates":{"lat":1.5,"lng":2.5},"country":"United States"},'
        '"company":{"name":"X","address":{"postalCode":"10001","country":"United States"}}}',
        '{"id":2,"firstname":"Bo"}',
    ]) + "\n")
    frame = scan.scan_users_json(spark, str(tmp_path))
    picked = frame.select(
        "id", "firstname", "lastname", "address.statecode", "address.postalcode",
        "address.coordinates.lat", F.col("company.address.postalcode").alias("c"),
        F.col("address").isNull().alias("none"),
    )
    assert rows(picked) == [
        (1, "Ann", "Lee", "CA", "94000", 1.5, "10001", False),
        (2, "Bo", None, None, None, None, None, True),
    ]


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_landing_appends_by_date_and_replaces_the_same_date(spark, tmp_path, file_format):
    path = str(tmp_path / "orders")
    one = spark.createDataFrame([("1", " a "), ("2", "")], "invoiceno string, country string")
    two = spark.createDataFrame([("3", "b")], "invoiceno string, country string")
    landing.land_snapshot(one, path, "2026-01-01", file_format)
    landing.land_snapshot(two, path, "2026-01-02", file_format)
    landing.land_snapshot(two, path, "2026-01-02", file_format)
    reader = spark.read.schema("invoiceno string, country string, ingestion_date string")
    if file_format == "csv":
        reader = reader.option("header", True)
    found = reader.format(file_format).load(path).fillna("")
    assert rows(found) == [
        ("1", " a ", "2026-01-01"), ("2", "", "2026-01-01"), ("3", "b", "2026-01-02"),
    ]


def test_landing_an_empty_delivery_replaces_the_date(spark, tmp_path):
    path = str(tmp_path / "orders")
    one = spark.createDataFrame([("1", "a")], "invoiceno string, country string")
    landing.land_snapshot(one, path, "2026-01-01", "json")
    landing.land_snapshot(one, path, "2026-01-02", "json")
    landing.land_snapshot(one.limit(0), path, "2026-01-01", "json")
    reader = spark.read.schema("invoiceno string, country string, ingestion_date string")
    assert rows(reader.json(path)) == [("1", "a", "2026-01-02")]


def test_discovery_takes_any_column_and_folder_and_refuses_another_folder(spark, tmp_path):
    path = str(tmp_path / "it's here")
    landing.land_snapshot(spark.createDataFrame([("1",)], "`a b` string"), path, "2026-01-01", "parquet")
    found = landing.discover_partitions(spark, "odd_name", path, "`a b` STRING")
    assert rows(found) == [("1", "2026-01-01")]
    with pytest.raises(ValueError):
        landing.discover_partitions(spark, "odd_name", str(tmp_path / "other"), "`a b` STRING")
    spark.sql("DROP TABLE odd_name")


def test_snapshots_keep_every_row_without_a_key(spark):
    catalog = spark.createDataFrame(
        [(None, "x", "2026-01-01"), (None, "y", "2026-01-01"), (1, "z", "2026-01-01")],
        "id int, v string, ingestion_date string",
    )
    assert sorted(r.v for r in landing.latest_snapshot(catalog, "id").collect()) == ["x", "y", "z"]


def test_samples_of_repeated_keys_are_ordered_by_date(spark):
    from orelode.operators.bronze import nested_projection

    data = [(1, d, d[-2:]) for d in ("2026-01-03", "2026-01-01", "2026-01-04", "2026-01-02")]
    frame = spark.createDataFrame(data, "id int, ingestion_date string, v string").repartition(4)
    assert [r.v for r in nested_projection(frame, "id", {"v": "v"}).collect()] == ["01", "02", "03"]


def test_published_cells_keep_their_digits(spark):
    from orelode.functions.measures import plain_text

    values = [0.1234, 0.001, 20.0, 12345678.5, 1e-7, -2.5e-10, 1.5e22, -1e7, 123456789.125, 0.0,
              float("inf"), float("nan"), None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in frame.select(plain_text(F.col("v"), "double")).collect()]
    assert found == [
        "0.1234", "0.001", "20.00", "12345678.50", "0.0000001", "-0.00000000025",
        "15000000000000000000000.00", "-10000000.00", "123456789.125", "0.00", "Infinity", "NaN", None,
    ]


def test_landing_defaults_to_today(spark, tmp_path):
    landing.land_snapshot(spark.range(1), str(tmp_path / "x"), file_format="json")
    assert [n for n in os.listdir(tmp_path / "x") if n.startswith("ingestion_date=20")]


def test_discover_partitions_picks_up_later_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([("1",)], "v string")
    landing.land_snapshot(rows_, path, "2026-01-01", "parquet")
    assert landing.discover_partitions(spark, "found_t", path, "v STRING").count() == 1
    landing.land_snapshot(rows_, path, "2026-01-02", "parquet")
    found = landing.discover_partitions(spark, "found_t", path, "v STRING")
    assert rows(found) == [("1", "2026-01-01"), ("1", "2026-01-02")]


def test_latest_snapshot(spark):
    catalog = spark.createDataFrame(
        [(1, "old", "2026-01-01"), (1, "new", "2026-01-03"), (2, "only", "2026-01-01"),
         (3, "b", "2026-01-01"), (3, "a", "2026-01-01")],
        "id int, v string, ingestion_date string",
    )
    latest = landing.latest_snapshot(catalog, "id")
    assert rows(latest) == [
        (1, "new", "2026-01-03"), (2, "only", "2026-01-01"), (3, "b", "2026-01-01"),
    ]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().toString()


def test_partitioned_write_keeps_text_partitions_and_refreshes(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame(
        [(1, "2026", "04"), (2, "2026", "05")], "v int, year string, month string"
    )
    sinks.write_partitioned_parquet(frame, path)
    folder = versions.version_folder(spark, path)
    assert os.path.isdir(f"{folder}/year=2026/month=04")
    assert any(n.endswith(".snappy.parquet") for n in os.listdir(f"{folder}/year=2026/month=04"))
    april = frame.filter("month = '04'").withColumn("v", F.lit(9))
    after = sinks.write_partitioned_parquet(april, path, refresh_only=True)
    assert rows(after) == [(2, "2026", "05"), (9, "2026", "04")]
    rebuilt = sinks.rebuild_zone(april, path, ("year", "month"))
    assert rows(rebuilt) == [(9, "2026", "04")]


def test_rebuild_of_an_unpartitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.rebuild_zone(spark.range(3), path)
    assert rows(sinks.rebuild_zone(spark.range(1), path)) == [(0,)]


def test_publish_keeps_history_and_replaces_latest(spark, tmp_path):
    path = str(tmp_path)

    def result(revenue):
        return {"q1_total": spark.createDataFrame([(revenue, 2)], "net_revenue double, lines long"),
                "extra": spark.createDataFrame([(None,)], "note string")}

    report.publish_results(result(12345678.5), path, "run-1")
    published = report.publish_results(result(20.0), path, "run-2")
    assert rows(published["q1_total"]) == [(20.0, 2)]
    found = report.read_report(spark, f"{path}/latest/report")
    assert rows(found) == [
        ("Annex", "extra", 1, "note", ""),
        ("Q1", "q1_total", 1, "lines", "2"),
        ("Q1", "q1_total", 1, "net_revenue", "20.00"),
    ]
    history = spark.read.json(f"{path}/history/raw/q1_total").select("run_id", "net_revenue")
    assert rows(history) == [("run-1", 12345678.5), ("run-2", 20.0)]
    ordered = report.read_by_question(spark, f"{path}/latest/by_question").collect()
    assert [(r.question, r.place, r.query, r.value) for r in ordered] == [
        ("Annex", 99, "extra", ""), ("Q1", 1, "q1_total", "20.00"), ("Q1", 1, "q1_total", "2"),
    ]
    assert os.path.isdir(f"{path}/history/by_question/run_id=run-1")
    first = report.read_report(spark, f"{path}/history/report/run_id=run-1")
    assert ("Q1", "q1_total", 1, "net_revenue", "12345678.50") in rows(first)


def broken_lines(root):
    put(root, "a.jsonl", '{"id":1,"title":"é"}\nnot json\n\n{"id":"three"}\n{"id":2,\n', "2026-01-01")
    put(root, "b.jsonl", '[1,2]\n{"id":4} trailing\n{"id":5}\n"text"\nnull\n', "2026-01-02")
    put(root, "c.jsonl", "  \n", "2026-01-02")


def test_unreadable_lines_are_found_where_they_lie(spark, tmp_path):
    broken_lines(tmp_path)
    found = scan.unreadable_lines(spark, str(tmp_path))
    assert found.columns == ["file", "offset", "ingestion_date", "text"]
    for row in found.collect():
        data = (tmp_path / f"ingestion_date={row.ingestion_date}" / row.file).read_bytes()
        assert data[row.offset :].startswith(row.text.encode() + b"\n")
    texts = {(r.file, r.text) for r in found.collect()}
    assert {("a.jsonl", "not json"), ("a.jsonl", '{"id":2,'), ("b.jsonl", "[1,2]"), ("b.jsonl", '"text"'), ("b.jsonl", "null")} <= texts
    assert ("a.jsonl", '{"id":"three"}') not in texts and ("b.jsonl", '{"id":5}') not in texts


def test_lines_balance_with_the_scan(spark, tmp_path):
    broken_lines(tmp_path)
    found = {r.file: r for r in scan.line_balance(spark, str(tmp_path)).collect()}
    assert all(r.passed for r in found.values())
    assert (found["a.jsonl"].lines, found["a.jsonl"].blank, found["c.jsonl"].blank) == (5, 1, 1)
    scanned = scan.scan_products_json(spark, str(tmp_path))
    assert sum(r.unreadable + r.readable for r in found.values()) == scanned.count()
    assert sum(r.unreadable for r in found.values()) == scan.unreadable_lines(spark, str(tmp_path)).count()


def test_offsets_go_on_over_the_blocks_of_a_file(spark, tmp_path):
    texts = [f"broken {i} " + "x" * (i % 97) if i % 50 == 0 else '{"id":%d}' % i for i in range(4000)]
    put(tmp_path, "long.jsonl", "\n".join(texts) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        found = scan.unreadable_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    data = (tmp_path / "ingestion_date=2026-01-01" / "long.jsonl").read_bytes()
    assert len(found) == 80
    assert all(data[r.offset :].startswith(r.text.encode() + b"\n") for r in found)


def test_json_lines_land_packed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LANDED_LINES", 40)
    path = landing.land_snapshot(spark.range(0, 100, 1, 1), str(tmp_path / "x"), "2026-01-01", "json")
    files = [n for n in os.listdir(f"{path}/ingestion_date=2026-01-01") if n.startswith("part-")]
    assert len(files) == 3 and all(n.endswith(".json.gz") for n in files)
    assert scan.scan_products_json(spark, path).selectExpr("count(*)", "sum(id)").first()[:] == (100, 4950)


def test_csv_lands_packed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LANDED_LINES", 40)
    lines = spark.range(0, 100, 1, 1).selectExpr("cast(id AS string) AS invoiceno", "' a\"b, ' AS country")
    path = landing.land_snapshot(lines, str(tmp_path / "x"), "2026-01-01")
    files = [n for n in os.listdir(f"{path}/ingestion_date=2026-01-01") if n.startswith("part-")]
    assert len(files) == 3 and all(n.endswith(".csv.gz") for n in files)
    found = spark.read.schema("invoiceno string, country string").option("header", True).option("escape", '"').csv(path)
    assert rows(found.drop("ingestion_date")) == rows(lines)


def test_blank_lines_are_told_by_their_first_other_sign(spark):
    lines = ["", " \t\f\u000b\r ", " x", "x ", " ", " ", " \n ", " \n{}"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    blank = [row[0] for row in frame.select(scan._blank()).collect()]
    assert blank == [True, True, False, False, False, False, True, False]
    assert "trim" not in frame.select(scan._blank())._jdf.queryExecution().optimizedPlan().toString()
