"""Validation, typing, files, sinks and the daily load."""

import base64
import contextlib
import datetime as dt
import gzip
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from basketry import fixed_values
from basketry.operators import aggregates, transform, validate
from basketry.operators.serial import add_serial, top_n_for_chart
from basketry.operators.validate import SalesDataError
from basketry.plans import daily_load, dashboard, store_reports as report_jobs
from basketry.schemas import SALES_COLUMNS
from basketry.sinks import tables as sinks
from basketry.sources import files, star, tables

RAW = "invoice string, orderDate string, quantity string, totalProductPrice string"


def test_required_columns(spark):
    with pytest.raises(SalesDataError, match="quantity"):
        validate.require_columns(spark.range(1), ["id", "quantity"])


def test_rules_let_unreadable_values_pass(spark):
    df = spark.createDataFrame([
        ("I1", "2024-01-01", "1", "10"), ("I2", "2024-01-01", "abc", "nan"), ("I3", "2024-01-01", None, None),
        ("I4", "2024-01-01", "0", "-1"), (" ", "2024-01-01", "1", "1"), (None, "2024-01-01", "-1", "1")], RAW)
    one = validate.validation_report(df).first()
    assert (one["total_rows"], one["dropped_rows"], one["remaining_rows"]) == (6, 3, 3)
    assert (one["negative_price"], one["nonpositive_quantity"], one["blank_invoice"]) == (1, 2, 2)
    assert sorted(r["invoice"] for r in validate.drop_invalid(df).collect()) == ["I1", "I2", "I3"]
    failed = {r["quantity"]: r["failed_rules"] for r in validate.quarantine(df).collect()}
    assert failed["0"] == ["negative_price", "nonpositive_quantity"]
    assert {r["rule"] for r in validate.validation_samples(df).collect()} == set(validate.RULES)


def test_rule_without_its_column_is_skipped(spark):
    df = spark.createDataFrame([("1",)], "quantity string")
    assert "negative_price" not in validate.validation_report(df).columns


def test_guards(spark):
    with pytest.raises(SalesDataError):
        validate.guard_not_empty(spark.range(0))
    columns = "invoice string, orderDate date, brandName string, storeName string, subCategoryOf string, productName string, totalProductPrice string, quantity int"
    undated = spark.createDataFrame([("I", None, "b", "s", "c", "p", "1", 1)], columns)
    with pytest.raises(SalesDataError, match="dated"):
        validate.validate_agg_input(undated)


def test_store_exclusion_keeps_null_names(spark):
    df = spark.createDataFrame([("A",), (None,), ("B",)], "storeName string")
    kept = validate.exclude_store(df, "A")
    assert {r[0] for r in kept.collect()} == {None, "B"}
    validate.assert_store_absent(kept, "storeName", "A")
    with pytest.raises(SalesDataError):
        validate.assert_store_absent(df, "storeName", "A")


def test_target_schema(spark):
    df = spark.createDataFrame([("3.0", "1e2", "x", "y")], "quantity string, totalProductPrice string, productMrp string, extra string")
    out = transform.transform_sales(df)
    assert out.columns == SALES_COLUMNS
    assert (out.first()["quantity"], float(out.first()["totalProductPrice"])) == (3, 100.0)


def test_rename_chains_follow_rule_order():
    assert transform.resolve_rules([("a", "b"), ("b", "c")]) == {"a": "c", "b": "c"}
    assert transform.resolve_rules([("b", "c"), ("a", "b")]) == {"b": "c", "a": "b"}
    rules = transform.resolve_rules(fixed_values.PRODUCT_RENAMES)
    assert len(fixed_values.PRODUCT_RENAMES) == 37
    assert rules["Coca Cola Diet Coke Carbonated Soft Drink Can 300ml"] == "Coca Cola Diet Coke Carbonated Drink 300ml"
    assert rules["Cadbury Dairy Milk Silk Roast Almond Chocolate Bar 58g"] == "Cadbury Dairy Milk Silk Roast Almond Choco 58g"


def test_renames_leave_other_rows(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "productname string, n int")
    got = {r["n"]: r["productname"] for r in transform.rename_products(df, [("a", "b"), ("b", "c")]).collect()}
    assert got == {1: "c", 2: "z", 3: None}


def test_two_columns_for_one_name(spark):
    with pytest.raises(SalesDataError):
        transform.standardise_columns(spark.createDataFrame([(1, 2)], "unit_price int, sales int"))


def test_serial_over_many_partitions(spark):
    df = spark.range(5000).repartition(7).select((F.lit(5000) - F.col("id")).alias("v"))
    rows = add_serial(df, [F.col("v")]).collect()
    assert sorted((r["s_no"], r["v"]) for r in rows) == [(i, i) for i in range(1, 5001)]
    assert [r["v"] for r in top_n_for_chart(df.withColumn("n", F.col("v")), "v", "n", 2).collect()] == [5000, 4999]


def test_payloads(spark, tmp_path):
    body = "invoice,note,quantity\nI1,\"a, b\",2\nI2,,3\n"
    (tmp_path / "plain.csv").write_text(body)
    packed = base64.b64encode("quantity,invoice\n5,I3\n".encode()).decode()
    (tmp_path / "packed.csv").write_text(packed[:10] + "\n " + packed[10:])
    rows = files.decode_report_payloads(spark, str(tmp_path), ["invoice", "quantity", "note"]).collect()
    assert {(r["invoice"], r["quantity"], r["note"]) for r in rows} == {("I1", "2", "a, b"), ("I2", "3", None), ("I3", "5", None)}


def test_store_files(spark, tmp_path):
    (tmp_path / "Main_Road.csv").write_text("productName,quantity\nP,abc\nQ,4\n")
    (tmp_path / "Unknown.csv").write_text("productName,quantity\nP,1\n")
    (tmp_path / "Café 1+1.csv").write_text("productName,quantity\nR,9\n")
    stores = spark.createDataFrame([("Main/Road",), ("Nowhere",), ("Café 1+1",)], "storeName string")
    rows = files.read_store_csv_dir(spark, str(tmp_path), ["productName", "quantity"], ["quantity"], stores).collect()
    assert {(r["storeName"], r["productName"], r["quantity"]) for r in rows} == {
        ("Main/Road", "P", 0.0), ("Main/Road", "Q", 4.0), ("Café 1+1", "R", 9.0)}


def test_partners_need_a_number_column(spark, tmp_path):
    (tmp_path / "p.csv").write_text("storeName,wa_number\nA,1\nB,\n")
    assert files.read_partners(spark, str(tmp_path / "p.csv")).count() == 1
    (tmp_path / "q.csv").write_text("storeName\nA\n")
    with pytest.raises(SalesDataError):
        files.read_partners(spark, str(tmp_path / "q.csv"))


def test_date_slices_cover_each_day_once():
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    slices = tables.date_slices("d", start, end, 4)
    days = [start + dt.timedelta(days=i) for i in range(31)]
    import re
    bounds = [re.findall(r"'(\S+)'", s) for s in slices]
    hits = [sum(lo <= str(day) < hi for lo, hi in bounds) for day in days]
    assert len(slices) == 4 and hits == [1] * 31
    assert sinks.jdbc_options()["batchsize"] == "1000"


def test_overwrite_is_idempotent_and_keeps_other_dates(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "v int, orderDate date"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([(1, d1), (2, d2), (3, None)], schema)
    for _ in range(2):
        sinks.overwrite_dates(first, path)
    sinks.overwrite_dates(spark.createDataFrame([(9, d1)], schema), path)
    assert sorted((r["v"], r["orderDate"]) for r in spark.read.parquet(path).where("v <> 3").collect()) == [(2, d2), (9, d1)]
    assert spark.read.parquet(path).count() == 3


def test_aggregate_dates_without_rows_are_cleared(spark, tmp_path):
    root, schema = str(tmp_path), "n string, orderdate date"
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    dates = spark.createDataFrame([(d,) for d in days], "orderdate date")
    sinks.overwrite_aggregates({"t": spark.createDataFrame([("a", days[0]), ("b", days[1])], schema)}, root, dates)
    sinks.overwrite_aggregates({"t": spark.createDataFrame([("c", days[0])], schema)}, root, dates)
    assert [tuple(r) for r in spark.read.parquet(f"{root}/t").select("n").collect()] == [("c",)]


def test_upsert_replaces_by_key(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "storename string, name string, week_start date, total_sales double"
    w1, w2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    keys = ["storename", "name", "week_start"]
    sinks.upsert_snapshot(spark.createDataFrame([("S", "A", w1, 1.0), ("S", "B", w1, 2.0), ("S", None, w1, 3.0), ("S", "A", w2, 4.0)], schema), path, keys, "week_start")
    sinks.upsert_snapshot(spark.createDataFrame([("S", "A", w1, 9.0), ("S", None, w1, 8.0), ("T", "A", w1, 7.0)], schema), path, keys, "week_start")
    rows = spark.read.parquet(path).collect()
    assert sorted(r["total_sales"] for r in rows) == [2.0, 4.0, 7.0, 8.0, 9.0]
    assert all(r["created_at"] is not None for r in rows)


def test_chunked_export(spark, tmp_path):
    sinks.export_chunked(spark.range(25).repartition(1), str(tmp_path / "x"), [F.col("id")], max_rows=10)
    parts = sorted(p for p in (tmp_path / "x").iterdir() if p.suffix == ".csv")
    sizes = [len(p.read_text().splitlines()) - 1 for p in parts]
    assert sum(sizes) == 25 and max(sizes) <= 10


def test_daily_load_end_to_end(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    raw = star.raw_sales(spark, sf_dir)
    for _ in range(2):
        daily_load.load_sales(spark, raw, root, excluded_store="Head Office")
    fact = spark.read.parquet(f"{root}/billing_data")
    undated, rejected = (spark.read.parquet(f"{root}/{n}").count() for n in ("undated_data", "rejected_data"))
    assert rejected == validate.validation_report(raw).first()["dropped_rows"]
    assert fact.count() + undated == validate.validation_report(raw).first()["remaining_rows"]
    sums = {n: float(spark.read.parquet(f"{root}/{n}").agg(F.sum("sales")).first()[0])
            for n in ("brand_sales", "store_sales", "category_sales", "product_sales")}
    used = fact.where("orderDate is not null and storeName <> 'Head Office'").agg(F.sum("totalProductPrice")).first()[0]
    assert set(sums.values()) == {float(used)}
    reports = dashboard.daily_dashboard(spark, root)
    assert reports["brands"].count() > 0 and reports["total"].count() == 1
    assert reports["stores"].where("storename = 'Head Office'").count() == 0


def test_the_load_reads_the_raw_text_once(spark, sf_dir, tmp_path):
    raw, read = star.raw_sales(spark, sf_dir).limit(3000), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    daily_load.load_sales(spark, raw.mapInArrow(counted, raw.schema), str(tmp_path))
    assert read.value == 3000
    stored = lambda name: spark.read.parquet(f"{tmp_path}/{name}").drop("load_id").first().asDict()
    assert stored("load_validation") == validate.validation_report(raw).first().asDict()
    assert stored("load_date_formats") == validate.date_format_profile(raw).first().asDict()
    assert stored("load_profile") == validate.load_profile(transform.transform_sales(validate.drop_invalid(raw))).first().asDict()


def test_three_loads_build_the_raw_lines_once(spark, sf_dir, monkeypatch):
    from basketry.plans import catalog

    raw, read = star.raw_sales(spark, sf_dir), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = raw.count()
    monkeypatch.setattr(star, "raw_sales", lambda s, d: raw.mapInArrow(counted, raw.schema))
    rows = {r["table_name"]: r["row_count"] for r in catalog.queries()["daily_load"](spark, sf_dir).collect()}
    assert read.value == n == rows["billing_data"] + rows["undated_data"] + rows["rejected_data"]


def test_dashboard_opens_only_the_days_it_compares(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    daily_load.load_sales(spark, star.raw_sales(spark, sf_dir), root)
    before = {n: sorted(map(str, df.collect())) for n, df in dashboard.daily_dashboard(spark, root).items()}
    assert before["brands"] and before["products"]
    for name in dashboard.TABLES:
        days = sorted((tmp_path / name).glob("orderdate=*"))
        assert len(days) > 12
        for day in days[:-9]:
            for file in day.glob("*.parquet"):
                file.write_bytes(b"not to be read")
    spark.catalog.clearCache()
    assert {n: sorted(map(str, df.collect())) for n, df in dashboard.daily_dashboard(spark, root).items()} == before


def test_stored_renames_rewrite_only_the_days_that_change(spark, sf_dir, tmp_path):
    from basketry.plans.rename_stored import rename_stored

    root = str(tmp_path)
    daily_load.load_sales(spark, star.raw_sales(spark, sf_dir), root)
    facts = lambda: spark.read.parquet(f"{root}/billing_data")
    old, n = facts().where("productName is not null").groupBy("productName").count().orderBy("count", "productName").first()
    files_of = lambda name: {p: p.stat().st_mtime_ns for p in (tmp_path / name).rglob("*.parquet")}
    before = {t: files_of(t) for t in ("billing_data", "product_sales")}
    total = facts().count()
    days = {r[0] for r in facts().where(F.col("productName") == old).select("orderDate").distinct().collect()}
    changed = rename_stored(spark, root, [(old, "between"), ("between", "new name")]).collect()
    assert {r["orderDate"] for r in changed} == days and sum(r["renamed_rows"] for r in changed) == n
    spark.catalog.clearCache()
    assert facts().count() == total and facts().where(F.col("productName") == "new name").count() == n
    assert facts().where(F.col("productName") == old).count() == 0
    products = spark.read.parquet(f"{root}/product_sales")
    assert {r[0] for r in products.where("productname = 'new name'").select("orderdate").collect()} == days
    assert products.where(F.col("productname") == old).count() == 0
    for table, found in before.items():
        kept = {p: t for p, t in found.items() if p.parent.name.split("=")[1] not in {str(d) for d in days}}
        assert len(kept) > 0 and kept.items() <= files_of(table).items()
    assert rename_stored(spark, root, [(old, "new name")]).count() == 0


def test_loads_and_renames_leave_no_working_files(spark, sf_dir, tmp_path):
    """Landed rows and shuffles go when they have been used, and renamed days are written without a shuffle of their rows."""
    from basketry.plans.rename_stored import rename_stored

    root, env = str(tmp_path), spark.sparkContext._jvm.org.apache.spark.SparkEnv
    landed = lambda: set(pathlib.Path(spark.conf.get("spark.checkpoint.dir")).glob("basketry-landed-*"))
    shuffles = lambda: {f for f in env.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    rows_moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = landed(), shuffles()
    daily_load.load_sales(spark, star.raw_sales(spark, sf_dir), root)
    facts = spark.read.parquet(f"{root}/billing_data")
    old = facts.where("productName is not null").groupBy("productName").count().orderBy("count", "productName").first()[0]
    days, size = facts.where(F.col("productName") == old).select("orderDate").distinct().count(), facts.count()
    moved = rows_moved()
    assert rename_stored(spark, root, [(old, "new name")]).count() == days
    moved = rows_moved() - moved
    spark.catalog.clearCache()
    assert spark.read.parquet(f"{root}/billing_data").count() == size
    assert landed() <= before[0] and len(shuffles() - before[1]) < 30
    assert moved < 25 * size


def test_loads_keep_the_undated_rows_of_others(spark, tmp_path):
    fields = "invoice string, orderDate string, quantity string, totalProductPrice string, storeName string, brandName string, subCategoryOf string, productName string, productId string, orderType string"
    load = lambda n: spark.createDataFrame([(f"{n}{i}", day, "1", "2.5", "S", "b", "c", "p", "7", "online") for i, day in enumerate(("2024-01-0" + n, "soon", ""))], fields)
    for n in ("1", "2", "1"):
        counts = {r[0]: r[1] for r in daily_load.load_sales(spark, load(n), str(tmp_path)).collect()}
    assert sorted(r["invoice"] for r in spark.read.parquet(f"{tmp_path}/undated_data").collect()) == ["11", "12", "21", "22"]
    assert spark.read.parquet(f"{tmp_path}/billing_data").count() == 2
    assert (counts["billing_data"], counts["undated_data"], counts["rejected_data"], counts["brand_sales"]) == (1, 2, 0, 1)


def test_wide_downloads_and_quoted_line_breaks(spark, tmp_path):
    wide = [f"c{i}" for i in range(100)]
    body = "\n".join([",".join(wide + ["note"]), "", ",".join(["v"] * 100 + ['"two\r\nlines, ""quoted"""']), ",".join([""] * 100 + ['5" pipe'])])
    (tmp_path / "w.csv").write_bytes(("\ufeff" + body + "\n").encode())
    rows = files.decode_report_payloads(spark, str(tmp_path), ["note", "c99", "c0", "absent"]).collect()
    assert {tuple(r)[1:] for r in rows} == {('two\r\nlines, "quoted"', "v", "v", None), ('5" pipe', None, None, None)}
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "s.csv").write_text('invoice,note\nI1,"a\nb"\nI2,"say ""x"""\n')
    assert {tuple(r) for r in files.read_sales_csv(spark, str(plain)).collect()} == {("I1", "a\nb"), ("I2", 'say "x"')}
    stores = tmp_path / "stores"
    stores.mkdir()
    (stores / "A.csv").write_text("extra,quantity,productName\nx,2,P\n")
    assert [tuple(r) for r in files.read_store_csv_dir(spark, str(stores), ["productName", "quantity"], ["quantity"]).collect()] == [("A", "P", 2.0)]


def test_downloads_are_read_in_short_lines(spark, tmp_path):
    """Bodies that begin like base64 and are not, that end with the letter that cuts them, wrapped, compressed; and no body
    of some size is one value for a task."""
    letters = "".join(chr(97 + i % 26) for i in range(80_000))
    note = 'say ""x"",\r\n\nand é'
    body = "\ufeffinvoice,note\n" + "".join(f'I{i},"{note}{i}"\n' for i in range(40_000)) + "end,"
    pack = lambda text: base64.b64encode(text.encode()).decode()
    downloads = {
        "plain.csv": body.encode(), "packed.csv": pack(body).encode(), "wrapped.csv": base64.encodebytes(body.encode()), "short.csv": pack("invoice\nA\n").encode(),
        "letters.csv": f"invoice{letters}\nI,1\n".encode(), "name.csv": b"invoice\nABCD\n-\n", "lost.csv": pack("invoice\nA\n").encode() + b"A",
        "zipped.csv.gz": gzip.compress(pack(body).encode()), "open.csv": b'invoice,note\nI,"open\n', "empty.csv": b"", "blank.csv": b" \n\n"}
    for name, data in downloads.items():
        (tmp_path / name).write_bytes(data)
    want = [("I%d" % i, 'say "x",\r\n\nand é%d' % i) for i in range(40_000)] + [("end", None)]
    scanned, read_text = [], type(spark.read).text
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "text", lambda self, *a, **k: scanned.append(read_text(self, *a, **k)) or scanned[-1])
        for most in ("128m", "100k"):  # files in one part, and in several where a session insists on it
            if most == "100k":
                patch.setattr(files, "_whole_files", lambda *a: contextlib.nullcontext(False))
                spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            try:
                got = files.decode_report_payloads(spark, str(tmp_path), ["invoice", "note", f"invoice{letters}"]).collect()
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
            of = lambda name: sorted(tuple(r)[1:] for r in got if r["source_file"] == name)
            for name in ("plain.csv", "packed.csv", "wrapped.csv", "zipped.csv.gz"):
                assert of(name) == sorted((a, b, None) for a, b in want), name
            assert of("short.csv") == [("A", None, None)] and of("letters.csv") == [(None, None, "I")]
            assert of("name.csv") == [("-", None, None), ("ABCD", None, None)] and of("open.csv") == [("I", "open\n", None)]
            assert not of("lost.csv") and not of("empty.csv") and not of("blank.csv")
    lines = [df for df in scanned if not any(f.endswith((".gz", "empty.csv")) for f in df.inputFiles())]
    assert lines and max(df.agg(F.max(F.octet_length("value"))).first()[0] for df in lines) <= 80_100


def test_records_do_not_depend_on_how_a_body_is_cut():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice('ab,"\r\n é') for _ in range(rng.randrange(60)))
        for packed in (False, True):
            data = base64.b64encode(text.encode()) if packed else text.encode()
            whole = files.CsvRecords(packed).feed(data, last=True)
            size, cut, found = rng.randrange(1, 7), files.CsvRecords(packed), []
            for at in range(0, len(data), size):
                found += cut.feed(data[at:at + size])
            assert found + cut.feed(b"", last=True) == whole
    cut = files.CsvRecords(False)
    assert sum(len(cut.feed(b'a,"b\n""c",d\n' * 1000)) for _ in range(50)) >= 49_999 and len(cut.left) < 20


def test_rule_tables_give_the_names_of_rule_lists(spark):
    rules = [("a", "b"), ("b", "c"), ("x", "a"), ("c", "d"), ("d", "a"), ("a", "e"), ("k", "k"), ("b", "z")]
    rules += [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("n40", "n0")]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "seq int, old string, new string")
    names = {old: old for old, _ in rules}
    for old, new in rules:
        names = {start: new if name == old else name for start, name in names.items()}
    assert {r["old"]: r["new"] for r in transform.resolve_rule_table(table).collect()} == names == transform.resolve_rules(rules)
    for seq in ([0, 0], [0, None]):
        twice = spark.createDataFrame([(s, "a", "b") for s in seq], "seq int, old string, new string")
        with pytest.raises(SalesDataError, match="seq"):
            transform.rename_products(spark.createDataFrame([("a",)], "productname string"), twice)


def test_null_names_have_no_base_in_the_month(spark):
    from basketry.operators import comparisons

    lines = spark.createDataFrame(
        [(None, dt.date(2024, 3, 5), 40.0), (None, dt.date(2024, 4, 5), 10.0), ("A", dt.date(2024, 2, 5), 8.0), ("A", dt.date(2024, 4, 1), 6.0)],
        "storeName string, orderDate date, totalProductPrice double")
    april = dt.date(2024, 4, 1)
    found = {(r["storeName"], r["total_sales"], r["avg_monthly_sales"]) for r in comparisons.store_monthly(lines, april).collect()}
    assert found == {(None, 10.0, 0.0), ("A", 6.0, 4.0)}
    sales = lines.toDF("subcategoryof", "orderdate", "sales")
    found = [(r["subcategoryof"], r["total_sales"], r["avg_monthly_sales"]) for r in comparisons.category_monthly(sales, april).collect()]
    assert sorted(found, key=str) == sorted([(None, 10.0, 0.0), (None, 0.0, 20.0), ("A", 6.0, 4.0)], key=str)


def test_weekly_job_uses_earlier_snapshots(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    lines = star.billing(spark, sf_dir)
    report_jobs.run_weekly(spark, lines.where(F.col("orderDate") <= F.lit(star.LAST_DAY - dt.timedelta(days=7))), root)
    report_jobs.run_weekly(spark, lines, root, stock=star.stock(spark, sf_dir))
    found = spark.read.parquet(f"{root}/weekly_signals")
    assert found.where("sales_change is not null").count() > 0
    assert spark.read.parquet(f"{root}/weekly_brand_snapshot").select("week_start").distinct().count() >= 2
    assert spark.read.parquet(f"{root}/weekly_report").where("current_stock is not null").count() > 0
    for name in ("summary", "gems", "reserved", "bands", "concentration", "margin_risk", "headline", "anomalies"):
        assert spark.read.parquet(f"{root}/weekly_{name}").count() > 0, name


def test_same_totals_by_brand_and_store(spark, sf_dir):
    lines = star.billing(spark, sf_dir)
    totals = [t.agg(F.sum("sales")).first()[0] for t in (
        aggregates.brand_sales(lines), aggregates.store_sales(lines), aggregates.category_sales(lines), aggregates.product_sales(lines))]
    assert len(set(totals)) == 1


def test_many_stores_take_the_salted_join(spark, sf_dir, monkeypatch):
    from basketry.operators import store_reports as sr
    from basketry.operators.staging import stage

    lines = star.billing(spark, sf_dir)
    weeks = stage(sr.store_weeks(lines))
    few = sr.weekly_brand(lines, weeks).collect()
    monkeypatch.setattr(tables, "MAX_BROADCAST_PERIODS", 1)
    assert sorted(map(str, sr.weekly_brand(lines, weeks).collect())) == sorted(map(str, few))


def test_store_files_are_scanned_as_csv_and_split(spark, tmp_path):
    (tmp_path / "A [1].csv").write_text("﻿productName,quantity\n" + "".join(f"P{i},{i}\n" for i in range(20000)))
    (tmp_path / "B.csv").write_text('other,quantity,productName\nx,1,"two\nlines, ""q"""\n   \ny,,\n')
    (tmp_path / "C.csv").write_text("")
    (tmp_path / "D.csv").write_text("quantity\n7\n")
    read = lambda **k: files.read_store_csv_dir(spark, str(tmp_path), ["productName", "quantity"], **k)
    rows = read()
    assert "Scan text" not in rows._jdf.queryExecution().toString() and rows.where("storeName = 'A [1]'").count() == 20000
    assert {tuple(r) for r in rows.where("storeName <> 'A [1]'").collect()} == {
        ("B", 'two\nlines, "q"', "1"), ("B", None, None), ("D", None, "7")}
    (tmp_path / "B.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = read(multi_line=False)
        assert split.count() == 20001 and split.where("storeName = 'A [1]'").rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
