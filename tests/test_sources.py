"""Load modes, versioned tables, checkpoints and key merge."""

import shutil
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockyard.operators import marts
from stockyard.schemas import CHECKPOINT, GEO_REFERENCE
from stockyard.sources import checkpoints, extract, tables
from stockyard.streaming import incremental

NOW = datetime(2024, 3, 10, 1)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_updates_inserts_and_repeats_without_change(spark, path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    tables.merge_by_key(spark, old, path, ["k"])
    for _ in range(2):
        tables.merge_by_key(spark, new, path, ["k"])
        assert content(tables.read(spark, path)) == [("a", 1), ("b", 20), ("c", 30)]
    assert tables.versions(spark, path) == [1, 2, 3]
    assert tables.expire(spark, path, keep=1) == [1, 2]
    assert content(tables.read(spark, path)) == [("a", 1), ("b", 20), ("c", 30)]


def test_merge_null_keys(spark, path):
    row = spark.createDataFrame([("a", None, 1)], "k string, l string, v int")
    for safe, count in ((True, 1), (False, 2)):
        where = f"{path}-{safe}"
        tables.merge_by_key(spark, row, where, ["k", "l"], null_safe=safe)
        tables.merge_by_key(spark, row, where, ["k", "l"], null_safe=safe)
        assert tables.read(spark, where).count() == count


def test_merge_refuses_a_repeated_key(spark, path):
    with pytest.raises(tables.MergeError):
        tables.merge_by_key(spark, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), path, ["k"])
    assert not tables.exists(spark, path)


def test_unfinished_version_is_not_read(spark, path, tmp_path):
    tables.overwrite(spark.createDataFrame([("a", 1)], "k string, v int"), path)
    (tmp_path / "table" / "v00000002").mkdir()
    assert tables.versions(spark, path) == [1]
    assert content(tables.read(spark, path)) == [("a", 1)]
    tables.overwrite(spark.createDataFrame([("b", 1)], "k string, v int"), path)
    assert content(tables.read(spark, path)) == [("b", 1)]


def test_merge_partitions_rewrites_only_what_it_touches(spark, path, tmp_path):
    schema = "d date, k string, v int"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    tables.merge_partitions(
        spark, spark.createDataFrame([(d1, "a", 1), (d2, "a", 2), (d2, "b", 3)], schema), path, ["d", "k"], "d"
    )
    untouched = tmp_path / "table" / "v00000001" / f"{tables.PART}=p2024-01-01"
    kept = sorted(p.name for p in untouched.glob("*.parquet"))
    tables.merge_partitions(spark, spark.createDataFrame([(d2, "b", 30)], schema), path, ["d", "k"], "d")
    assert content(tables.read(spark, path)) == [(d1, "a", 1), (d2, "a", 2), (d2, "b", 30)]
    assert kept and kept == sorted(p.name for p in untouched.glob("*.parquet"))
    null_day = spark.createDataFrame([(None, "n", 1)], schema)
    for _ in range(2):
        tables.merge_partitions(spark, null_day, path, ["d", "k"], "d")
    assert tables.read(spark, path).where("d is null").count() == 1 and tables.read(spark, path).count() == 4
    with pytest.raises(TypeError):
        tables.merge_partitions(spark, null_day, f"{path}-k", ["d", "k"], "k")


def files(tmp_path, part):
    folder = tmp_path / "table" / "v00000001" / f"{tables.PART}={part}"
    return sorted(p.name for p in folder.glob("*.parquet"))


def test_a_row_moves_to_another_month(spark, path, tmp_path):
    """The date is no part of the key: the months in which the new keys are stored are written too, and no other."""
    schema, by = "k string, at timestamp_ntz, v int", tables.By("at", "month")
    day = lambda m: datetime(2024, m, 5)
    rows = [("a", day(1), 1), ("b", day(1), 2), ("c", day(2), 3), ("d", day(3), 4), (None, None, 5)]
    tables.merge_partitions(spark, spark.createDataFrame(rows, schema), path, ["k"], by)
    january, march = files(tmp_path, "p2024-01"), files(tmp_path, "p2024-03")
    tables.merge_partitions(spark, spark.createDataFrame([("c", day(4), 30), (None, day(4), 50)], schema), path, ["k"], by)
    assert content(tables.read(spark, path)) == sorted(
        [("a", day(1), 1), ("b", day(1), 2), ("c", day(4), 30), ("d", day(3), 4), (None, day(4), 50)], key=repr
    )
    assert january == files(tmp_path, "p2024-01") and march == files(tmp_path, "p2024-03")
    assert not files(tmp_path, "p2024-02") and not files(tmp_path, "p-")
    tables.merge_partitions(spark, spark.createDataFrame([], schema), path, ["k"], by)
    assert tables.read(spark, path).count() == 5 and tables.versions(spark, path) == [1]
    wide = spark.createDataFrame([("e", day(3), 6, "x")], f"{schema}, w string")
    tables.merge_partitions(spark, wide, path, ["k"], by)
    assert content(tables.read(spark, path).where("at >= '2024-03-01' and at < '2024-04-01'")) == [("d", day(3), 4, None), ("e", day(3), 6, "x")]


def test_touched_folders_are_pruned_at_the_scan(spark, path):
    tables.create(spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 2, 1), 2)], "d date, k int"), path, ["d", "k"], partition="d")
    plan = tables._stored(spark, path).where(F.col(tables.PART).isin("p2024-01-01"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part_key" in plan.replace("isnotnull(part_key#", "part_key#")


def test_schema_grows_but_types_stay(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    wide = tables.merged(old, spark.createDataFrame([("b", 2, "x")], "k string, v int, w string"), ["k"])
    assert content(wide) == [("a", 1, None), ("b", 2, "x")]
    narrow = tables.merged(wide, spark.createDataFrame([("c",)], "k string"), ["k"])
    assert ("c", None, None) in content(narrow)
    with pytest.raises(TypeError):
        tables.merged(old, spark.createDataFrame([("b", "2")], "k string, v string"), ["k"])


def test_optional_source(spark, path):
    assert tables.optional_source(spark, path, GEO_REFERENCE).schema == GEO_REFERENCE
    assert tables.optional_table(spark, "no_such_table", GEO_REFERENCE).isEmpty()


def test_append_new_is_idempotent(spark, path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    tables.append_new(df, path, ["k"])
    tables.append_new(df, path, ["k"])
    assert tables.read(spark, path).count() == 2


MOVES = "operator_user string, warehouse_id string, product_id string, qty_delta int, movement_date timestamp_ntz"
KEY = ["operator_user", "warehouse_id", "period_date"]


def test_materialize(spark, path):
    def load(*days):
        rows = [("op", "W", "p", -1, datetime(2024, 3, d, h)) for d, h in days]
        movements = spark.createDataFrame(rows, MOVES)
        return lambda since: marts.operator_productivity(movements, since)

    def counts():
        return {r.period_date.day: r.movement_count for r in tables.read(spark, path).collect()}

    run = lambda build, **how: tables.materialize(spark, path, KEY, build, "period_date", **how)
    run(load((1, 8), (2, 8)))
    run(load((1, 8), (2, 8), (2, 9), (3, 8)))  # the stored day stays closed
    assert counts() == {1: 1, 2: 1, 3: 1}
    run(load((1, 8), (2, 8), (2, 9), (3, 8)), lookback=timedelta(days=2))
    assert counts() == {1: 1, 2: 2, 3: 1}
    run(load((5, 8)), full_refresh=True)
    assert counts() == {5: 1}


def test_materialize_by_partition(spark, path):
    rows = [("op", "W", "p", -1, datetime(2024, 3, d, 8)) for d in (1, 2, 2)]
    movements = spark.createDataFrame(rows, MOVES)
    for _ in range(2):
        tables.materialize(
            spark, path, KEY, lambda since: marts.operator_productivity(movements, since), "period_date",
            lookback=timedelta(days=1), partition="period_date",
        )
    stored = tables.read(spark, path)
    assert dict(stored.dtypes)["period_date"] == "timestamp_ntz" and tables.versions(spark, path) == [1]
    assert {r.period_date.day: r.movement_count for r in stored.collect()} == {1: 1, 2: 2}


def test_empty_target_has_no_bound(spark, path):
    tables.overwrite(spark.createDataFrame([], "period_date timestamp_ntz"), path)
    assert tables.high_water(spark, path, "period_date") is None


DOC = "SEQUENCIADOCUMENTO string, NUMERODOCUMENTO string, SERIEDOCUMENTO string, TIPODOCUMENTO string, " \
    "CODIGOEMPRESA string, CODIGODEPOSITANTE string, DATAEMISSAO timestamp_ntz, DATAENTREGA timestamp_ntz, " \
    "VALORTOTALDOCUMENTO decimal(15,2), SEQUENCIAINTEGRACAO string"


def documents(spark, *days):
    rows = [
        ("1", str(i), "1", "NF", "C", "D", datetime(2024, 3, d), None, Decimal("9.50"), str(i))
        for i, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, DOC)


def test_incremental_load(spark, path):
    entity, bronze, marks = extract.ENTITIES["orders_documento"], f"{path}/bronze", f"{path}/checkpoints"

    def load(run, *days, at=NOW, **how):
        return extract.extract(spark, documents(spark, *days), entity, bronze, marks, run, at, **how)

    first = load("r1", 1, 8, 9, days=7)
    assert (first.rows, first.watermark, first.window_start) == (2, datetime(2024, 3, 9), NOW - timedelta(days=7))
    assert checkpoints.last_value(spark, marks, entity.name) == datetime(2024, 3, 9)
    second = load("r2", 1, 8, 9, 10)
    assert second.rows == 2  # the boundary row is read again
    stored = tables.read(spark, f"{bronze}/orders_documento")
    assert stored.count() == 4 and dict(stored.dtypes)["valortotaldocumento"] == "double"
    assert stored.columns[-1] == "_cdc_loaded_at"
    empty = load("r3", at=NOW + timedelta(days=1))
    assert empty.rows == 0 and checkpoints.last_value(spark, marks, entity.name) == datetime(2024, 3, 10)
    replay = load("r4", 1, 8, 9, window=(datetime(2024, 3, 1), datetime(2024, 3, 2)))
    assert replay.rows == 1 and checkpoints.last_value(spark, marks, entity.name) == datetime(2024, 3, 10)
    full = load("r5", 1, 8, 9, mode=extract.FULL_WINDOW, days=90)
    assert full.rows == 3
    row = checkpoints.load(spark, marks).first()
    assert (row.status, row.last_successful_run_id, row.checkpoint_type) == ("success", "r5", "timestamp")
    assert checkpoints.load(spark, marks).schema == CHECKPOINT
    checkpoints.reset(spark, marks, entity.name)
    assert checkpoints.last_value(spark, marks, entity.name) is None


def test_snapshot_load_replaces(spark, path):
    entity = extract.ENTITIES["products_snapshot"]
    schema = "CODIGOPRODUTO string, DESCRICAOPRODUTO string, CLASSIFICACAOPRODUTO string"
    for i, names in enumerate((("a", "b"), ("c",))):
        source = spark.createDataFrame([(n, n, "X") for n in names], schema)
        extract.extract(spark, source, entity, path, f"{path}/marks", f"run{i}", NOW)
    assert [r.codigoproduto for r in tables.read(spark, f"{path}/products_snapshot").collect()] == ["c"]


def test_checkpoint_is_kept_on_failure_and_on_too_few_rows(spark, path):
    def mark(status, value):
        return checkpoints.Checkpoint("e", "oracle_wms", "timestamp", value, "r", NOW, NOW, NOW, status)

    assert checkpoints.save(spark, path, mark("success", "2024-01-01T00:00:00"), rows=5)
    assert not checkpoints.save(spark, path, mark("failed", "2024-02-01T00:00:00"), rows=5)
    assert not checkpoints.save(spark, path, mark("success", "2024-03-01T00:00:00"), rows=0, min_rows=1)
    assert checkpoints.last_value(spark, path, "e") == datetime(2024, 1, 1)


def test_lower_bound():
    assert extract.lower_bound(extract.INCREMENTAL, NOW, NOW, 2) == NOW
    assert extract.lower_bound(extract.INCREMENTAL, None, NOW, 2) == NOW - timedelta(days=2)
    assert extract.lower_bound(extract.FULL_WINDOW, NOW, NOW, 90) == NOW - timedelta(days=90)


def test_watermark_reaches_the_scan(spark, path):
    documents(spark, 1, 2).write.parquet(path)
    plan = extract.scan(spark.read.parquet(path), "DATAEMISSAO", NOW)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(DATAEMISSAO" in plan


def test_normalise(spark):
    df = spark.sql(
        "select cast(1.5 as decimal(9,2)) a, date'2024-01-02' b, timestamp'2024-01-02 03:00:00+02:00' c, 'x' d, "
        "timestamp_ntz'2024-01-02 03:00:00' e"
    )
    assert extract.normalise(df).first() == (
        1.5, datetime(2024, 1, 2), datetime(2024, 1, 2, 1), "x", datetime(2024, 1, 2, 3),
    )


def test_mask(spark):
    df = spark.createDataFrame([("a", "b", "c"), (None, None, "d")], "CPF string, Email string, name string")
    assert content(extract.mask_columns(df)) == [("***", "***", "c"), (None, None, "d")]


def test_envelope(spark, path):
    df = spark.createDataFrame([(1, None)], "id int, note string")
    wrapped = extract.envelope(df, "orders", "oracle_wms", "T", "run", NOW)
    assert wrapped.first().payload == '{"id":1,"note":null}'
    assert extract.envelope_violations(wrapped).isEmpty()
    assert extract.envelope_violations(wrapped.withColumn("payload", F.lit(None).cast("string"))).count() == 1
    extract.write_envelope(wrapped, path)
    assert spark.read.parquet(path).where("entity_name = 'orders' and extraction_date = '2024-03-10'").count() == 1


def test_envelopes_by_entity_and_day(spark, path):
    """A repeated run replaces its rows; a day is read from its folders only; the source rows come back."""
    def store(run, day, *rows, entity="orders"):
        df = spark.createDataFrame(rows, "id int, price decimal(9,2), at timestamp_ntz")
        extract.write_envelope(extract.envelope(df, entity, "oracle_wms", "T", run, NOW + timedelta(days=day)), path)
        return df

    one, two = (1, Decimal("1.50"), NOW), (2, None, None)
    store("r1", 0, one, two)
    store("r2", 1, (3, Decimal("3.00"), NOW))
    store("r3", 1, (9, None, None), entity="other")
    schema = store("r1", 0, one).schema  # the run again, with one row fewer
    rows = extract.read_envelope(spark, path, "orders")
    assert sorted(r.ingestion_run_id for r in rows.collect()) == ["r1", "r2"]
    assert content(extract.unwrapped(extract.read_envelope(spark, path, "orders", last=NOW.date()), schema)) == [one]
    day = extract.read_envelope(spark, path, "orders", NOW.date(), NOW.date(), "r1")
    assert extract.envelope_violations(day).isEmpty()
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "extraction_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert len(day.inputFiles()) == 3 and day._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_load_by_way_of_envelopes(spark, path):
    entity = extract.ENTITIES["orders_documento"]
    for name, raw in (("plain", None), ("raw", f"{path}/envelopes")):
        extract.extract(spark, documents(spark, 8, 9), entity, f"{path}/{name}", f"{path}/marks-{name}", "r1", NOW, days=7, raw_root=raw)
    assert content(tables.read(spark, f"{path}/raw/orders_documento")) == content(tables.read(spark, f"{path}/plain/orders_documento"))
    assert extract.read_envelope(spark, f"{path}/envelopes", entity.name).count() == 2


def test_counts_come_from_the_footers(spark, path, monkeypatch):
    tables.create(spark.range(50).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) as d"), f"{path}/a", ["id"], partition="d")
    tables.append(spark.range(7), f"{path}/b")
    tables.append(spark.range(5), f"{path}/b")
    plans, before = [], spark.conf.get("spark.sql.sources.useV1SourceList")
    union = tables.reduce
    def seen(f, frames):
        if all(hasattr(x, "columns") for x in frames):
            plans.extend(x._jdf.queryExecution().executedPlan().toString() for x in frames)
        return union(f, frames)
    monkeypatch.setattr(tables, "reduce", seen)
    assert content(tables.row_counts(spark, {"a": f"{path}/a", "b": f"{path}/b"})) == [("a", 50), ("b", 12)]
    assert len(plans) == 2 and all("PushedAggregation: [COUNT(*)]" in p and "ReadSchema: struct<count(*):bigint>" in p for p in plans)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_the_bound_of_an_increment_is_found_at_run_time(spark, path):
    rows = [("op", "W", "p", -1, datetime(2024, 3, d, 8)) for d in (1, 2, 3)]
    movements = spark.createDataFrame(rows, MOVES)
    tables.overwrite(movements, f"{path}/m")
    tables.overwrite(marts.operator_productivity(movements.where("movement_date < '2024-03-02'")), f"{path}/mart")
    fact, mart = tables.read(spark, f"{path}/m"), tables.read(spark, f"{path}/mart")
    new = marts.operator_productivity(fact, tables.bound(mart, "period_date"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = new._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("DataFilters" in line and "movement_date" in line and "Subquery" in line for line in plan.splitlines())
    assert sorted(r.period_date.day for r in new.collect()) == [2, 3]
    assert marts.operator_productivity(fact, tables.bound(mart.limit(0), "period_date")).count() == 3


def test_jdbc_options():
    with pytest.raises(ValueError):
        extract.jdbc_options("jdbc:x", "t")
    plain = extract.jdbc_options("jdbc:x", "t", one_task=True)
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "2000", "pushDownPredicate": "true"}
    split = extract.jdbc_options("jdbc:x", "t", split_column="id", bounds=(0, 9), splits=3)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "3"


def test_preview_and_query_rows(spark):
    df = spark.range(600).selectExpr(*[f"id as {c}" for c in extract.PREVIEWS["orders"]])
    assert extract.preview(df, extract.PREVIEWS["orders"]).count() == 500
    assert len(extract.query_rows(spark, "select * from range(80)")) == 50
    assert extract.query_rows(spark, "select 1 as a") == ['{"a":1}']


def test_streamed_files_are_loaded_once(spark, path):
    source, target, marks = f"{path}/in", f"{path}/out", f"{path}/marks"
    df = spark.createDataFrame([("a", Decimal("1.50"))], "k string, v decimal(9,2)")
    for n in (1, 2):
        df.write.mode("append").parquet(source)
        for _ in range(2):
            incremental.load_available(spark, source, df.schema, target, marks, NOW).awaitTermination()
        assert content(tables.read(spark, target).select("k", "v")) == [("a", 1.5)] * n


def test_appends_are_published_and_repeatable(spark, path, tmp_path):
    df = lambda v: spark.createDataFrame([("a", v)], "k string, v int")
    tables.append(df(1), path, "run 1")
    for _ in range(2):
        tables.append(df(2), path, "run 2")
    (tmp_path / "table" / "v00000001+run-3").mkdir()  # an append that was lost midway
    assert content(tables.read(spark, path)) == [("a", 1), ("a", 2)]
    tables.overwrite(df(9), path)
    tables.overwrite(df(10), path)
    assert tables.expire(spark, path, keep=1) == [1, 2]
    assert [p.name for p in (tmp_path / "table").iterdir()] == ["v00000003"]


def test_a_lost_merge_leaves_no_trace(spark, path, tmp_path):
    """A run is lost after it has written its merged day and before the swap; a full refresh and the next merge follow."""
    schema = "d date, k string, v int"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    one = lambda *rows: spark.createDataFrame(rows, schema)
    tables.merge_partitions(spark, one((d1, "a", 1), (d2, "a", 2), (d2, "b", 3)), path, ["d", "k"], "d")
    lost = tmp_path / "table" / "v00000001" / ".spark-staging-lost" / f"{tables.PART}=p2024-01-02"
    lost.mkdir(parents=True)
    shutil.copytree(tmp_path / "table" / "v00000001" / f"{tables.PART}=p2024-01-02", lost, dirs_exist_ok=True)
    assert tables.read(spark, path).count() == 3
    tables.create(one((d2, "x", 7), (d2, "y", 8)), path, ["d", "k"], partition="d")
    tables.merge_partitions(spark, one((d2, "y", 80), (d1, "c", 4)), path, ["d", "k"], "d")
    assert content(tables.read(spark, path)) == [(d1, "c", 4), (d2, "x", 7), (d2, "y", 80)]


def test_appended_columns_come_back(spark, path):
    """Each append keeps its own columns; reading gives all of them, and a changed type is refused at the door."""
    tables.append(spark.createDataFrame([("a", 1)], "k string, v int"), path, "1")
    tables.append(spark.createDataFrame([("b", 2, "x")], "k string, v int, w string"), path, "2")
    tables.append(spark.createDataFrame([("c", 1.5)], "k string, z double"), path, "3")
    stored = tables.read(spark, path)
    assert set(stored.columns) == {"k", "v", "w", "z"}
    assert content(stored.select("k", "v", "w", "z")) == [("a", 1, None, None), ("b", 2, "x", None), ("c", None, None, 1.5)]
    with pytest.raises(TypeError):
        tables.append(spark.createDataFrame([("d", "2")], "k string, v string"), path, "4")
    assert tables.read(spark, path).count() == 3


def test_two_streams_load_into_one_table(spark, path):
    target = f"{path}/out"
    for name in ("x", "y"):
        df = spark.createDataFrame([(name, Decimal("1.50"))], "k string, v decimal(9,2)")
        df.write.parquet(f"{path}/{name}")
        incremental.load_available(spark, f"{path}/{name}", df.schema, target, f"{path}/marks-{name}", NOW).awaitTermination()
    assert content(tables.read(spark, target).select("k")) == [("x",), ("y",)]


def test_few_files_per_partition(spark, path, tmp_path):
    days = spark.range(3000).repartition(16).selectExpr("date_add(date'2024-01-01', cast(id % 10 as int)) as d", "id")
    tables.create(days, path, ["d", "id"], partition="d")
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 10


def test_movements_bound_reaches_the_scan(spark, path):
    rows = [("1", NOW, None), ("2", None, NOW), ("3", None, None), ("4", NOW - timedelta(days=9), NOW)]
    spark.createDataFrame(rows, "sequenciamovimento string, datamovimento timestamp_ntz, datahistorico timestamp_ntz").write.parquet(path)
    kept = extract.source_window(spark.read.parquet(path), extract.ENTITIES["movements_entrada_saida"], NOW - timedelta(days=1))
    assert sorted(r.sequenciamovimento for r in kept.collect()) == ["1", "2"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "Or(GreaterThanOrEqual(datamovimento" in pushed and "And(IsNull(datamovimento),GreaterThan" in pushed
