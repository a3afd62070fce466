"""The given tables in the shape of the mobility domain.

Each function is a plain projection, filter or join of whole tables. Rows are left out of a dimension
by business attributes (balance, region, segment), so that facts meet unknown members too.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart import tables as t
from starmart.functions.time import NTZ, ntz
from starmart.operators import facts as facts_op
from starmart.operators import scd2, timeline
from starmart.operators.calendar import calendar, clock
from starmart.operators.conform import conform
from starmart.operators.keys import assign_surrogate_keys
from starmart.operators.mart import build_mart
from starmart.operators.positions import raw_event_id
from starmart.operators.reconcile import align
from starmart.plans.analytics import route_hour, star_route_hour
from starmart.session import scratch_path
from starmart.sources.tables import read_table

# Columns of the given tables that the roles use. Declaring them saves a job per table.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

AS_OF = "2024-01-31 00:00:00"
BATCH = "b1"


class Dims(dict):
    """Dimensions by name, built on first use."""

    def __init__(self, domain: "Domain"):
        super().__init__()
        self.domain = domain

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self.domain, name)()
        return self[name]


class Domain:
    """Roles of the domain over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # Raw entities -----------------------------------------------------------------------------

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("full_name"),
            F.col("c_mktsegment").alias("status"), "c_acctbal",
        )

    def vehicles(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("vehicle_id"), F.col("s_name").alias("registration_number"),
            F.col("s_nationkey").alias("capacity"), "s_acctbal",
        )

    def stops(self) -> DataFrame:
        size = F.col("p_size").cast("decimal(9,6)")
        price = F.col("p_retailprice").cast("decimal(12,2)")
        return self.table("part").select(
            F.col("p_partkey").alias("stop_id"), F.col("p_brand").alias("stop_code"),
            F.col("p_name").alias("stop_name"), F.col("p_type").alias("zone"),
            F.when(F.col("p_type") != "PROMO", (size / 100 + 55).cast("decimal(9,6)")).alias("latitude"),
            F.when(F.col("p_type") != "PROMO", (price / 1000 + 36).cast("decimal(9,6)")).alias("longitude"),
        )

    def fare_products(self) -> DataFrame:
        return self.table("events").groupBy(F.col("event_type").alias("fare_product_id")).agg(
            F.upper(F.first("event_type")).alias("product_name"),
            F.max("value").alias("base_price"),
        )

    def _events(self) -> DataFrame:
        """Events with the number in their properties, parsed once. The properties are always one flat
        ``{"k": number}``, for which a pattern is five times as fast as a JSON parser per row."""
        number = F.regexp_extract("props", r'"k": *([0-9]+)', 1)
        return self.table("events").withColumn("k", number.try_cast("int"))

    def trips(self) -> DataFrame:
        k, kind = F.col("k"), F.col("event_type")
        return self._events().select(
            F.col("event_id").alias("trip_id"),
            "user_id",
            F.floor(k / 4).cast("int").alias("route_id"),
            F.when(kind != "signup", F.col("user_id")).alias("vehicle_id"),
            F.col("user_id").alias("origin_stop_id"),
            F.floor(F.col("value") * 10).cast("bigint").alias("destination_stop_id"),
            F.col("ts").alias("start_ts"),
            (F.col("ts") + F.make_dt_interval(mins=k)).cast(NTZ).alias("end_ts"),
            (k * 100).alias("distance_meters"),
            kind.alias("fare_product_id"),
            F.col("value").alias("fare_amount"),
            F.when(kind != "click", F.lit("USD")).alias("currency_code"),
            F.when(kind == "purchase", "completed").when(kind == "error", "canceled")
            .otherwise("in_progress").alias("trip_status"),
            F.col("ts").alias("created_at"),
        )

    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("payment_method"), F.col("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("payment_status"), F.col("o_orderdate").alias("created_at"),
        )

    def positions(self) -> DataFrame:
        k = F.col("k")
        return self._events().select(
            raw_event_id(F.col("user_id"), F.col("ts")).alias("raw_event_id"),
            F.col("user_id").alias("vehicle_id"),
            F.floor(k / 4).cast("int").alias("route_id"),
            F.col("ts").alias("event_ts"),
            (k.cast("decimal(9,6)") / 100 + 55).cast("decimal(9,6)").alias("latitude"),
            (k.cast("decimal(9,6)") / 50 + 37).cast("decimal(9,6)").alias("longitude"),
            F.col("value").alias("speed_kmph"),
            (k * 3).alias("heading_deg"),
            F.floor(F.col("value") * 10).cast("bigint").alias("nearest_stop_id"),
            F.floor(k / 25).cast("int").alias("partition_id"),
            F.col("event_id").alias("offset_in_partition"),
        )

    def route_history(self) -> DataFrame:
        """Two records per route: an older one that must lose, and the one of this batch."""
        segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
        valid_from = (
            F.when(segment == "AUTOMOBILE", "2024-01-15").when(segment == "BUILDING", "2023-12-15")
            .otherwise("2024-01-01")
        )
        renamed = F.when(F.col("c_nationkey") >= 13, F.concat("c_name", F.lit("-v2"))).otherwise(F.col("c_name"))
        versions = F.array(
            F.struct(F.concat("c_name", F.lit("-old")).alias("route_name"), ntz("2024-01-10 00:00:00").alias("src_updated_at")),
            F.struct(renamed.alias("route_name"), ntz("2024-01-20 00:00:00").alias("src_updated_at")),
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("route_id"),
            F.col("c_name").alias("route_code"),
            F.col("c_nationkey").cast("string").alias("route_type"),
            F.when(balance < 1000, "new").otherwise(segment).alias("description"),
            valid_from.cast(NTZ).alias("valid_from_ts"),
            F.lit(True).alias("is_active"),
            F.inline(versions),
        )

    # Staged ------------------------------------------------------------------------------------

    def staged(self, spec: t.StagingSpec) -> DataFrame:
        raw = {
            "users": self.users, "vehicles": self.vehicles, "stops": self.stops,
            "fare_products": self.fare_products, "trips": self.trips, "payments": self.payments,
            "vehicle_positions": self.positions, "routes": self.route_history,
        }[spec.entity]()
        return conform(raw, spec, BATCH, AS_OF)

    # Dimensions --------------------------------------------------------------------------------

    def _members(self, raw: DataFrame, key: str, nat: str, sk: str) -> DataFrame:
        return assign_surrogate_keys(raw.select(F.col(key).cast("string").alias(nat)), nat, sk)

    def dim_user(self) -> DataFrame:
        """Users in good standing; the others are unknown to the facts."""
        return self._members(self.users().filter("c_acctbal >= 0"), "user_id", "user_id_nat", "user_sk")

    def dim_vehicle(self) -> DataFrame:
        known = self.vehicles().filter("s_acctbal >= 0")
        return self._members(known, "vehicle_id", "vehicle_id_nat", "vehicle_sk")

    def dim_stop(self) -> DataFrame:
        return self._members(self.stops(), "stop_id", "stop_id_nat", "stop_sk")

    def dim_fare_product(self) -> DataFrame:
        offered = self.fare_products().filter("fare_product_id <> 'signup'")
        return self._members(offered, "fare_product_id", "fare_product_id_nat", "fare_product_sk")

    def dim_route(self) -> DataFrame:
        """Nations as routes; those of one region are not in the dimension."""
        regions = self.table("region").filter("r_name <> 'ASIA'")
        joined = self.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        keyed = assign_surrogate_keys(
            joined.withColumn("route_id_nat", F.col("n_nationkey").cast("string")), "route_id_nat", "route_sk"
        )
        return keyed.select(
            "route_sk", "route_id_nat", F.col("n_name").alias("route_code"),
            F.concat("n_name", F.lit(" line")).alias("route_name"), F.col("r_name").alias("route_type"),
            F.lit(True).alias("is_current"),
        )

    @cached_property
    def dims(self) -> Dims:
        return Dims(self)

    def stored_routes(self) -> DataFrame:
        """Versioned dimension before the batch: routes of all segments but one, one version each."""
        known = self.table("customer").filter("c_mktsegment <> 'MACHINERY'").withColumn(
            "route_id_nat", F.col("c_custkey").cast("string")
        )
        keyed = assign_surrogate_keys(known, "route_id_nat", "route_sk")
        return keyed.select(
            "route_sk", "route_id_nat", F.col("c_name").alias("route_code"),
            F.col("c_name").alias("route_name"), F.col("c_nationkey").cast("string").alias("route_type"),
            F.when(F.col("c_acctbal") >= 500, F.col("c_mktsegment")).alias("description"),
            F.lit(None).cast("string").alias("route_pattern_hash"),
            F.lit(None).cast("bigint").alias("default_fare_product_sk"),
            F.lit("2024-01-01").cast("date").alias("valid_from"),
            F.lit(t.OPEN_END).cast("date").alias("valid_to"),
            F.lit(True).alias("is_current"), F.lit("oltp").alias("src_system"),
            ntz("2024-01-01 00:00:00").alias("etl_loaded_at"),
        )

    def latest_routes(self) -> DataFrame:
        fares = self.dims["dim_fare_product"]
        return scd2.latest_versions(scd2.resolve_default_fare(self.staged(t.ROUTE), fares), AS_OF)

    def route_versions(self, **policy) -> DataFrame:
        return scd2.new_versions(self.stored_routes(), self.latest_routes(), AS_OF, **policy)

    def route_snapshot(self) -> DataFrame:
        """Next snapshot; the versions are written first because it reads them twice."""
        versions = self.route_versions(late_policy="accept")
        path = scratch_path(self.spark, "versions")
        versions.write.parquet(path)
        written = read_table(self.spark, path, dict(versions.dtypes))
        return scd2.snapshot(self.stored_routes(), written)

    def late_routes(self) -> DataFrame:
        """A second batch of route records: of half of the routes another start each, spread over two years."""
        start = F.date_add(F.lit("2023-06-01").cast("date"), (F.col("c_custkey") % 400).cast("int"))
        raw = self.table("customer").filter("c_nationkey < 12").select(
            F.col("c_custkey").alias("route_id"), F.col("c_name").alias("route_code"),
            F.concat("c_name", F.lit("-late")).alias("route_name"), F.col("c_nationkey").cast("string").alias("route_type"),
            F.col("c_mktsegment").alias("description"), start.cast(NTZ).alias("valid_from_ts"))
        return scd2.resolve_default_fare(conform(raw, t.ROUTE, "b2", AS_OF), self.dims["dim_fare_product"])

    def route_timeline(self) -> DataFrame:
        """The versioned dimension after both batches, with late versions in their places."""
        first = scd2.resolve_default_fare(self.staged(t.ROUTE), self.dims["dim_fare_product"])
        after = self._kept(timeline.merge(
            self.stored_routes(), self._kept(timeline.fresh_starts(self.stored_routes(), first, AS_OF), "starts")), "timeline")
        return timeline.merge(after, self._kept(timeline.fresh_starts(after, self.late_routes(), AS_OF), "starts"))

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        """A frame that is read more than once, written first."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return read_table(self.spark, path, dict(df.dtypes))

    def nation_versions(self) -> DataFrame:
        """Nations as versioned routes: all from the fifth on, even ones anew from the sixteenth on, and those of one region
        from an earlier day, which came late."""
        base = self.dim_route().withColumns({
            "description": F.lit(None).cast("string"), "route_pattern_hash": F.lit(None).cast("string"),
            "default_fare_product_sk": F.lit(None).cast("bigint"), "valid_from": F.lit("2024-01-05").cast("date"),
            "valid_to": F.lit(t.OPEN_END).cast("date"), "src_system": F.lit("oltp"), "etl_loaded_at": ntz(AS_OF)}).select(*t.DIM_ROUTE_SCHEMA)
        even = base.filter("cast(route_id_nat as int) % 2 = 0").withColumn("valid_from", F.lit("2024-01-16").cast("date"))
        early = base.filter("route_type = 'AMERICA'").withColumn("valid_from", F.lit("2023-12-01").cast("date"))
        return timeline.merge(base, even.unionByName(early).drop("route_sk"))

    # Facts and mart ------------------------------------------------------------------------------

    def fact_trip(self) -> DataFrame:
        return facts_op.fact_rows(self.staged(t.TRIP), self.dims, facts_op.trip_spec())

    def mart_facts(self) -> DataFrame:
        """Trip facts with the two lookups that decide which rows exist; the mart reads no others."""
        spec = facts_op.trip_spec()
        needed = [look for look in spec.lookups if look.out in spec.mandatory]
        rows = facts_op.resolve(self.staged(t.TRIP).withColumns(spec.derived), self.dims, needed)
        return rows.filter(" and ".join(f"{c} is not null" for c in spec.mandatory))

    def mart(self) -> DataFrame:
        return build_mart(self.mart_facts(), self.dims["dim_route"], AS_OF)

    def star(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.mart_facts(), self.dims["dim_route"], calendar(self.spark), clock(self.spark)

    def drifted_mart(self) -> DataFrame:
        """The mart with one region missing and one region off by a trip."""
        kept = self.mart().filter("route_type <> 'EUROPE'")
        off = F.when(F.col("route_type") == "AFRICA", 1).otherwise(0)
        return kept.withColumn("trips_total", F.col("trips_total") + off)

    def both_sources(self) -> tuple[DataFrame, DataFrame]:
        """Route-hours of the star and of the drifted mart, whole, over the last 7 days."""
        left = star_route_hour(*self.star(), AS_OF, 7, None, (2, 2, 2))
        right = route_hour(self.drifted_mart(), AS_OF, 7, None, (2, 2, 2))
        return align(left), align(right)

    def bridge(self) -> DataFrame:
        """Orders as routes and the parts of their lines as stops, each pair once."""
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("route_id"),
            F.col("l_partkey").cast("string").alias("stop_id"),
        ).distinct()
