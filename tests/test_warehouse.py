from __future__ import annotations

import dataclasses

import pytest
from helpers import frame, rows, texts
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.__main__ import main as cli
from starmart.operators import facts, quality
from starmart.plans import analytics
from starmart.plans.warehouse import Warehouse, load_batch
from starmart.sources import tables as io
from starmart.streaming.positions import load_positions, read_feed

AS_OF = "2024-01-31 00:00:00"


def write_raw(spark, base, name="Line 1", from_day="2024-01-01", day="2024-01-30", extra_user=False):
    def put(entity, schema, *values):
        frame(spark, schema, *values).coalesce(1).write.mode("overwrite").parquet(f"{base}/{entity}")

    users = [("U1", "a@x", "active"), ("U1", "b@x", "active")] + ([("U2", "c@x", "active")] if extra_user else [])
    put("users", "user_id string, email string, status string", *users)
    put("fare_products", "fare_product_id string, product_name string, base_price double", ("F1", "Single", 2.5))
    put("stops", "stop_id string, latitude double, longitude double", ("S1", 55.1, 37.1), ("S2", 55.2, 37.2))
    put("vehicles", "vehicle_id string, capacity bigint", ("V1", 40))
    put("routes", "route_id string, route_code string, route_name string, route_type string, "
        "default_fare_product_id string, valid_from_ts timestamp",
        ("R1", "B001", name, "bus", "F1", f"{from_day} 00:00:00"), ("R2", "T001", "Line 2", "tram", "F1", "2024-01-01 00:00:00"))
    trip = ("trip_id string, user_id string, route_id string, vehicle_id int, origin_stop_id string, "
            "destination_stop_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, distance_meters bigint, "
            "fare_product_id string, fare_amount double, trip_status string")
    put("trips", trip,
        (f"T1{day}", "U1", "R1", None, "S1", "S2", f"{day} 08:10:00", f"{day} 08:20:00", 900, "F1", 2.5, "completed"),
        (f"T2{day}", "U1", "R2", None, "S1", "S9", f"{day} 09:10:00", f"{day} 09:20:00", 800, "F1", 3.5, "canceled"),
        (f"T3{day}", "U2", "R1", None, "S1", "S2", f"{day} 08:30:00", f"{day} 08:40:00", 700, "F1", 1.5, "completed"),
        (f"T4{day}", "U1", "R9", None, "S1", "S2", f"{day} 08:30:00", None, 700, "F1", 1.5, "completed"))
    put("payments", "payment_id string, user_id string, amount double, created_at timestamp_ntz",
        ("P1", "U1", 2.5, f"{day} 08:05:00"), ("P2", "U9", 2.5, f"{day} 08:05:00"))
    put("vehicle_positions", "raw_event_id string, vehicle_id string, event_ts timestamp_ntz, latitude double, longitude double",
        ("V1-1", "V1", f"{day} 08:05:00", 55.1234567, 37.0), ("V9-1", "V9", f"{day} 08:05:00", 55.1, 37.0))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("house")
    raw, root = str(base / "raw"), str(base / "stored")
    write_raw(spark, raw)
    return raw, root, load_batch(spark, raw, root, "b1", AS_OF, first=True)


def test_counts_of_the_first_load(spark, loaded):
    counts = loaded[2]
    assert {v["rejected"] for v in counts["staging"].values()} == {0}
    assert {k: v["accepted"] for k, v in counts["staging"].items()} == {
        "stg_user": 2, "stg_fare_product": 1, "stg_stop": 2, "stg_vehicle": 1, "stg_route": 2, "stg_trip": 4,
        "stg_payment": 2, "stg_vehicle_position": 2}
    assert (counts["dim_date"], counts["dim_time"]) == (1826, 86400)
    assert (counts["dim_user"], counts["dim_stop"], counts["dim_route"], counts["dim_route_inserted"]) == (1, 2, 2, 2)
    assert counts["fact_trip"] == {"accepted": 2, "rejected": 2}
    assert counts["fact_payment"] == counts["fact_vehicle_position"] == {"accepted": 1, "rejected": 1}
    assert counts["mart"] == 2


def test_stored_tables(spark, loaded):
    house = Warehouse(spark, loaded[1])
    rejected = house.facts(facts.trip_spec(), t.TRIP, io.REJECTED)
    assert rows(rejected, "trip_id", "reject_reason", "start_date_key") == [
        ("T32024-01-30", "user_sk", 20240130), ("T42024-01-30", "route_sk", 20240130)]
    positions = house.facts(facts.position_spec(), t.VEHICLE_POSITION)
    assert texts(positions, "latitude") == [("55.123457",)]
    fares = rows(house.routes("b1").join(house.dim(t.DIM_FARE_PRODUCT), F.expr("default_fare_product_sk = fare_product_sk")), "route_code")
    assert fares == [("B001",), ("T001",)]
    assert rows(house.gates("b1")) == [(2, 2, 0, 2, True)]
    assert house.staged(t.TRIP, "b1").count() == 4 and house.staged(t.TRIP, "other").count() == 0


def test_partitions_are_pruned(spark, loaded, capsys):
    house = Warehouse(spark, loaded[1])
    analytics.route_hour(house.mart(), AS_OF).explain()
    assert "start_date" in capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]
    analytics.star_route_hour(house.trips(), house.routes("b1"), None, None, AS_OF).explain()
    filters = capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]
    assert "row_state" in filters and "start_date_key" in filters
    house.staged(t.TRIP, "b1").explain()
    assert "etl_batch_id" in capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]


def test_constraints(spark, loaded):
    found = Warehouse(spark, loaded[1]).constraints("b1", "b1")
    assert found.count() > 60 and rows(found.filter("violations > 0")) == []
    short = dataclasses.replace(t.STOP, lengths={"stop_id": 1}, required=("city",))
    checks = quality.staging_checks(Warehouse(spark, loaded[1]).staged(t.STOP), short)
    assert rows(checks) == [("stg_stop.city missing", 2), ("stg_stop.stop_id too long", 2)]


def test_hot_key_of_a_shuffle_lookup_is_split(spark, capsys):
    """Beyond the broadcast threshold AQE splits the partition of a key that holds a third of the rows."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    staged = spark.range(0, 60000, 1, 8).select(F.col("id").alias("f"), hot.alias("user_id"))
    others = spark.range(60000).select(F.col("id").cast("string").alias("user_id_nat"))
    members = others.union(spark.range(1).select(F.lit("hot")))
    dim = members.withColumn("user_sk", F.xxhash64("user_id_nat"))
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        look = facts.Lookup("dim_user", "user_id", "user_id_nat", "user_sk", "user_sk")
        found = facts.resolve(staged, {"dim_user": dim}, [look])
        wrong = found.filter("user_sk is null or user_sk <> xxhash64(user_id)")
        assert found.count() == 60000 and wrong.count() == 0
        found.collect()
        found.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_comparison_report(spark, loaded, tmp_path):
    done = cli(["compare", "--root", loaded[1], "--snapshot", "b1", "--out", str(tmp_path), "--as-of", "2024-01-31"])
    assert done["star_rows"] == done["mart_rows"] == 2
    compared = spark.read.option("header", True).csv(str(tmp_path / "route_hour_comparison"))
    assert rows(compared, "route_code", "status", "trips_diff", "fare_diff") == [
        ("B001", "matched", "0", "0.0"), ("T001", "matched", "0", "0.0")]
    assert spark.read.json(str(tmp_path / "performance_metrics")).first().star_rows == 2


def test_streamed_positions_equal_the_batch_load(spark, loaded, tmp_path):
    raw, root, _ = loaded
    house = Warehouse(spark, root)
    spec = facts.position_spec()
    batch = texts(house.facts(spec, t.VEHICLE_POSITION).drop("etl_batch_id"))
    # A house that shares the dimensions but has no positions yet.
    other = Warehouse(spark, str(tmp_path / "house"))
    for name in ("dim_vehicle", "dim_stop"):
        spark.read.parquet(house.path("dim", name)).write.parquet(other.path("dim", name))
    io.write_batch(house.routes("b1"), other.path("dim", "dim_route"), "b1")
    source = spark.read.parquet(f"{raw}/vehicle_positions")
    feed_path = str(tmp_path / "feed")
    source.write.parquet(feed_path)
    for _ in range(2):
        query = load_positions(read_feed(spark, feed_path, io.ddl(dict(source.dtypes))), other, "b1", AS_OF)
        query.awaitTermination()
        assert query.exception() is None
    assert texts(other.facts(spec, t.VEHICLE_POSITION).drop("etl_batch_id")) == batch
    source.filter("vehicle_id = 'V1'").write.mode("append").parquet(feed_path)
    load_positions(read_feed(spark, feed_path, io.ddl(dict(source.dtypes))), other, "b1", AS_OF).awaitTermination()
    assert texts(other.facts(spec, t.VEHICLE_POSITION).drop("etl_batch_id")) == batch + batch


def test_replay_changes_nothing_and_a_second_batch_adds(spark, loaded):
    raw, root, _ = loaded
    house = Warehouse(spark, root)

    def state(snapshot):
        return [texts(df) for df in (
            house.trips(), house.mart(), house.dim(t.DIM_USER), house.dim(t.DIM_STOP), house.staged(t.TRIP),
            house.routes(snapshot), house.facts(facts.trip_spec(), t.TRIP, io.REJECTED))]

    before = state("b1")
    again = load_batch(spark, raw, root, "b1", AS_OF)
    assert state("b1") == before and again["dim_user"] == again["dim_date"] == 0

    write_raw(spark, raw, name="Line 1 new", from_day="2024-01-31", day="2024-01-31", extra_user=True)
    second = load_batch(spark, raw, root, "b2", "2024-02-01 00:00:00", previous="b1")
    assert second["dim_user"] == 1 and second["dim_route_inserted"] == 1 and second["dim_route"] == 3
    assert second["fact_trip"] == {"accepted": 3, "rejected": 1}
    got = texts(house.routes("b2").filter("route_code = 'B001'"), "route_sk", "route_name", "valid_to", "is_current")
    assert got[1][1:] == ("Line 1", "2024-01-30", "false") or got[0][1:] == ("Line 1", "2024-01-30", "false")
    # Only current versions count: the hour of the closed version is gone, as in a full rebuild.
    hours = texts(house.mart(), "route_code", "start_hour", "trips_total")
    assert hours == [("B001", "2024-01-31 08:00:00", "2"),
                     ("T001", "2024-01-30 09:00:00", "1"), ("T001", "2024-01-31 09:00:00", "1")]
    after = state("b2")
    load_batch(spark, raw, root, "b2", "2024-02-01 00:00:00")
    assert state("b2") == after
    house.load_mart(None, "b2", AS_OF)
    assert texts(house.mart(), "route_code", "start_hour", "trips_total") == hours
    # A repeated batch whose trips moved to a day beyond the standard calendar leaves nothing on the old one.
    write_raw(spark, raw, name="Line 1 new", from_day="2024-01-31", day="2028-02-05", extra_user=True)
    moved = load_batch(spark, raw, root, "b2", "2024-02-01 00:00:00")
    assert moved["dim_date"] == 1
    hours = texts(house.mart(), "route_code", "start_hour", "trips_total")
    assert hours == [("B001", "2028-02-05 08:00:00", "2"), ("T001", "2024-01-30 09:00:00", "1"),
                     ("T001", "2028-02-05 09:00:00", "1")]
    star = analytics.star_route_hour(house.trips(), house.routes("b2"), None, None, "2028-02-06 00:00:00")
    assert texts(star, "route_code", "start_hour", "trips_total") == [hours[0], hours[2]]
    assert cli(["check", "--root", root, "--batch-id", "b2"]) == {"violated": 0}
    house.load_mart(None, "b2", AS_OF)
    assert texts(house.mart(), "route_code", "start_hour", "trips_total") == hours
    house.load_mart(None, "b2", AS_OF, version="by_key")
    assert len(texts(house.mart())) == 4


def test_previous_snapshot(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    with pytest.raises(ValueError):
        house.previous_snapshot("b1")
    assert house.previous_snapshot("b1", first=True) is None

    def put(batch, previous):
        for table, df in (("dim_route", spark.range(1)), ("dim_route_lineage", spark.createDataFrame([(previous,)], "previous string"))):
            io.write_batch(df, house.path("dim", table), batch)

    put("b1", None)
    put("b2", "b1")
    assert house.previous_snapshot("b3") == "b2" and house.previous_snapshot("b2") == "b1"
    assert house.previous_snapshot("b1") is None and house.previous_snapshot("b3", "b1") == "b1"
    for wrong in ({"previous": "b0"}, {"previous": "b3"}, {"first": True}):
        with pytest.raises(ValueError):
            house.previous_snapshot("b3", **wrong)
    put("b3", "b1")
    with pytest.raises(ValueError):
        house.previous_snapshot("b4")


def test_staging_rejects(spark, tmp_path):
    """Values that do not fit and missing keys are kept apart with their reasons and the raw row."""
    raw = frame(spark, "payment_id string, user_id string, amount double, created_at timestamp_ntz",
                ("P1", "U1", 2.5, None), ("P2", "U1", 123456789.0, None), (None, None, 1.0, None))
    house = Warehouse(spark, str(tmp_path))
    assert house.stage(raw, t.PAYMENT, "b1", AS_OF) == {"accepted": 1, "rejected": 2}
    assert rows(house.staged(t.PAYMENT), "payment_id") == [("P1",)]
    bad = house.staged(t.PAYMENT, "b1", io.REJECTED)
    assert rows(bad, "reject_reason") == [("amount does not fit",), ("payment_id missing, user_id missing",)]
    assert rows(bad.filter("payment_id = 'P2'").select(F.get_json_object("raw_row", "$.amount").cast("double"))) == [(123456789.0,)]


def test_missing_table_is_an_empty_frame(spark, tmp_path):
    df = io.read_table(spark, str(tmp_path / "none"), t.MART_SCHEMA, or_empty=True)
    with pytest.raises(AnalysisException):
        io.read_table(spark, str(tmp_path / "none"), t.MART_SCHEMA)
    assert df.count() == 0 and dict(df.dtypes) == t.MART_SCHEMA


def test_file_without_suffix(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"user_id": ["a"]}), tmp_path / "users")
    assert rows(io.read_raw(spark, str(tmp_path), "users")) == [("a",)]


def test_empty_replay_empties_the_batch(spark, tmp_path):
    df = frame(spark, "k int, etl_batch_id string", (1, "b1"))
    path = str(tmp_path / "t")
    assert io.write_batch(df, path, "b1") == 1 and io.write_batch(df, path, "b2") == 1
    assert io.write_batch(df.limit(0), path, "b1") == 0
    assert rows(io.read_table(spark, path, {"k": "int", "etl_batch_id": "string"})) == [(1, "b2")]
    with pytest.raises(ValueError):
        io.write_batch(df, path, "../b1")


def test_mart_write_replaces_dates_and_sorts(spark, tmp_path):
    path = str(tmp_path / "mart")

    def mart(*values):
        df = frame(spark, "route_id_nat string, start_hour timestamp_ntz, trips_total bigint", *values)
        return df.select(*(c if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in t.MART_SCHEMA.items()))

    first = mart(("b", "2024-01-01 01:00:00", 1), ("a", "2024-01-01 02:00:00", 1), ("a", "2024-01-02 01:00:00", 1))
    assert io.write_mart(first, path) == 3
    assert io.write_mart(mart(("a", "2024-01-01 05:00:00", 7)), path) == 1
    read = io.read_table(spark, path, t.MART_SCHEMA | {"start_date": "date"})
    assert texts(read, "route_id_nat", "start_hour") == [("a", "2024-01-01 05:00:00"), ("a", "2024-01-02 01:00:00")]
    io.write_mart(first, path, reload_all=True)
    in_file = [r[0] for r in read.sparkSession.read.parquet(path).filter("start_date = '2024-01-01'").select("route_id_nat").collect()]
    assert in_file == ["a", "b"]


def test_reports(spark, tmp_path):
    df = frame(spark, "a int, b string", (1, "x"))
    io.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().asDict() == {"a": "1", "b": "x"}
    io.write_metrics(spark, {"star_seconds": 0.5, "star_rows": 3}, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first().asDict() == {"star_seconds": 0.5, "star_rows": 3}


def test_jdbc_options():
    options = io.jdbc_options("jdbc:x", "dim_user", "u", "p", "d.Driver", split=("user_sk", 1, 100, 4))
    assert options["fetchsize"] == "10000" and options["numPartitions"] == "4" and options["upperBound"] == "100"
    assert "numPartitions" not in io.jdbc_options("jdbc:x", "t", "u", "p", "d.Driver")
