"""The batch load: raw files to staging, dimensions, facts and mart."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.functions.time import date_key, ntz
from starmart.operators import calendar as cal
from starmart.operators import delivery, quality, scd2, timeline
from starmart.operators.conform import batch_rows, checked
from starmart.operators.dimensions import keyed_members, new_members
from starmart.operators.facts import FactSpec, classified_rows, payment_spec, position_spec, trip_spec
from starmart.operators.mart import SUMS, dropped_hours, mart_of_sums, route_hour_sums
from starmart.operators.positions import deduplicate
from starmart.session import scratch_path
from starmart.sources import tables as io
from starmart.tables import (
    DIM_FARE_PRODUCT, DIM_ROUTE_SCHEMA, DIMENSIONS, MART_SCHEMA, PAYMENT, ROUTE, STAGING, TRIP,
    VEHICLE_POSITION, StagingSpec,
)

FACTS = ((trip_spec, TRIP), (payment_spec, PAYMENT), (position_spec, VEHICLE_POSITION))

#: Columns of the parts of the mart; sums are exact.
MART_SUMS = {"route_sk": "bigint", "start_hour": "timestamp_ntz"} | {
    c: "decimal(38,2)" if c == "fare_sum" else "bigint" for c in SUMS}

# Types of the columns a fact adds to those it takes over from staging.
_KEY_TYPES = {"_sk": "bigint", "_key": "int", "_sec": "int"}


def fact_schema(spec: FactSpec, source: StagingSpec) -> dict[str, str]:
    def kind(column: str) -> str:
        if column in source.columns:
            return source.columns[column]
        return next(t for suffix, t in _KEY_TYPES.items() if column.endswith(suffix))

    return {c: kind(c) for c in spec.columns} | {"etl_loaded_at": "timestamp_ntz"}


class Warehouse:
    """Stored tables below ``root``. Every stage is one write, and counts ride on it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def staged(self, spec: StagingSpec, batch_id: str | None = None, state: str = io.ACCEPTED) -> DataFrame:
        """Staging rows of a batch, or of all; rejected ones have their reason and raw row."""
        table = io.read_staged(self.spark, self.path("staging", spec.name), spec.schema, state)
        return batch_rows(table, batch_id)

    def dim(self, spec, or_empty: bool = False) -> DataFrame:
        return io.read_table(self.spark, self.path("dim", spec.name), spec.schema, or_empty)

    def routes(self, snapshot: str | None) -> DataFrame:
        """A snapshot of the versioned route dimension; with None that before the first load, which is empty."""
        if snapshot is None:
            return self.spark.createDataFrame([], io.ddl(DIM_ROUTE_SCHEMA))
        path = io.batch_folder(self.path("dim", "dim_route"), snapshot)
        return io.read_table(self.spark, path, DIM_ROUTE_SCHEMA)

    def snapshots(self) -> dict[str, str | None]:
        """Stored route snapshots, each with the one it builds on."""
        lineage = io.read_table(
            self.spark, self.path("dim", "dim_route_lineage"), {"previous": "string", "etl_batch_id": "string"}, or_empty=True)
        known = {r.etl_batch_id: r.previous for r in lineage.collect()}  # one row per batch
        return {b: known.get(b) for b in io.stored_batches(self.spark, self.path("dim", "dim_route"))}

    def previous_snapshot(self, batch_id: str, previous: str | None = None, first: bool = False) -> str | None:
        """The snapshot a batch builds on: the named one, for a repeated batch that of its former run, else the latest.

        Only a ``first`` load starts from nothing, and only while no other batch has a snapshot.
        """
        known = self.snapshots()
        others = sorted(set(known) - {batch_id})
        if first:
            if others or previous is not None:
                raise ValueError(f"not a first load: there are route snapshots of {others or previous}")
            return None
        if previous is not None:
            if previous not in others:
                raise ValueError(f"no route snapshot {previous!r} other than the batch's own; stored: {others}")
            return previous
        if batch_id in known:
            return known[batch_id]
        latest = sorted(set(known) - set(known.values()))
        if len(latest) != 1:
            raise ValueError(f"name the previous snapshot, or load as first; latest ones stored: {latest}")
        return latest[0]

    def facts(
        self, spec: FactSpec, source: StagingSpec, state: str = io.ACCEPTED, or_empty: bool = False
    ) -> DataFrame:
        return io.read_facts(
            self.spark, self.path("fact", spec.name), fact_schema(spec, source), state, or_empty)

    def trips(self) -> DataFrame:
        return self.facts(trip_spec(), TRIP)

    def mart(self) -> DataFrame:
        return io.read_table(self.spark, self.path("mart", "trip_route_hourly"),
                             MART_SCHEMA | {"start_date": "date"})

    def stage(self, raw: DataFrame, spec: StagingSpec, batch_id: str, as_of) -> dict[str, int]:
        """Store the rows of one entity; those with unfit or missing values apart, with the reasons."""
        return io.write_staged(checked(raw, spec, batch_id, as_of), self.path("staging", spec.name), batch_id)

    def load_staging(self, raw: str, batch_id: str, as_of) -> dict[str, dict[str, int]]:
        return {
            spec.name: self.stage(io.read_raw(self.spark, raw, spec.entity), spec, batch_id, as_of)
            for spec in STAGING
        }

    def load_generated(self, batch_id: str | None = None) -> dict[str, int]:
        """Clock and calendar, with the days of the staged batch that lie outside the standard years; rows
        that exist already are left alone."""
        moments = ((TRIP, ("start_ts", "end_ts")), (PAYMENT, ("created_at",)), (VEHICLE_POSITION, ("event_ts",)))
        days = (
            self.staged(spec, batch_id).select(F.explode(F.array(*(F.col(c).cast("date") for c in columns))))
            for spec, columns in moments
        )
        clock = self._append_absent("dim_time", cal.clock(self.spark), "time_key")
        return {"dim_date": self.extend_calendar(reduce(DataFrame.union, days)), "dim_time": clock}

    def extend_calendar(self, days: DataFrame) -> int:
        """Append the standard years and the given days (one date column) as far as the calendar lacks them."""
        return self._append_absent("dim_date", cal.calendar_with(self.spark, days), "date_key")

    def _append_absent(self, name: str, rows: DataFrame, key: str) -> int:
        path = self.path("dim", name)
        stored = io.read_table(self.spark, path, dict(rows.dtypes), or_empty=True)
        return io.append_rows(cal.insert_if_absent(stored, rows, key), path)

    def calendar(self) -> DataFrame:
        return io.read_table(self.spark, self.path("dim", "dim_date"), {"date_key": "int", "full_date": "date"})

    def load_dimensions(self, batch_id: str | None, as_of, first: bool = False) -> dict[str, int]:
        """Append new members. They are written first, because numbering them reads them twice."""
        counts = {}
        for spec in DIMENSIONS:
            dim = self.dim(spec, or_empty=first)
            pending = self._written(new_members(dim, self.staged(spec.source, batch_id), spec), spec.name)
            counts[spec.name] = io.append_rows(
                keyed_members(dim, pending, spec, as_of), self.path("dim", spec.name)
            )
        return counts

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        """The frame as a table in the shared folder, which cuts its lineage."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return io.read_table(self.spark, path, dict(df.dtypes))

    def load_routes(self, batch_id: str, previous: str | None, as_of, late_policy: str = "split", **policy) -> dict[str, int]:
        """Next snapshot of the route dimension, from the ``previous`` one, in its own folder.

        With ``late_policy='split'`` every start of the batch becomes a version, whenever it begins (see ``timeline``).
        ``'reject'`` and ``'accept'`` look at the latest record of a route and its current version only.
        """
        dim = self.routes(previous)
        staged = scd2.resolve_default_fare(self.staged(ROUTE, batch_id), self.dim(DIM_FARE_PRODUCT))
        if late_policy == "split":
            versions = self._written(timeline.fresh_starts(dim, staged, as_of), "route-versions")
            after = timeline.merge(dim, versions)
        else:
            latest = scd2.latest_versions(staged, as_of)
            versions = self._written(scd2.new_versions(dim, latest, as_of, late_policy=late_policy, **policy), "route-versions")
            after = scd2.snapshot(dim, versions)
        total = io.write_batch(after, self.path("dim", "dim_route"), batch_id)
        built_on = self.spark.range(1).select(F.lit(previous).cast("string").alias("previous"))
        io.write_batch(built_on, self.path("dim", "dim_route_lineage"), batch_id)
        return {"dim_route_inserted": versions.count(), "dim_route": total}

    def _dims(self, snapshot: str, version: str) -> dict[str, DataFrame]:
        routes = self.routes(snapshot)
        return {s.name: self.dim(s) for s in DIMENSIONS} | {
            "dim_route": routes if version == "as_of_event" else scd2.current_only(routes)}

    def load_facts(self, batch_id: str | None, snapshot: str, as_of, version: str = "current") -> dict[str, dict[str, int]]:
        """Facts of a batch, or of every staged batch one after the other, on the routes of a snapshot.

        With ``version='as_of_event'`` a fact gets the route version of its day; ``rebook`` then follows changed history.
        """
        dims, counts = self._dims(snapshot, version), {}
        for make_spec, source in FACTS:
            spec = make_spec()
            batches = [batch_id] if batch_id else io.stored_batches(self.spark, self.path("staging", source.name))
            done = {}
            for batch in batches:
                staged = self.staged(source, batch)
                events = deduplicate(staged) if source is VEHICLE_POSITION else staged  # positions come more than once
                rows = classified_rows(events, dims, spec, version)
                done[batch] = io.write_facts(
                    rows.withColumn("etl_loaded_at", ntz(as_of)), self.path("fact", spec.name), batch, spec.date_key)
            counts[spec.name] = {k: sum(n[k] for n in done.values()) for k in (io.ACCEPTED, io.REJECTED)}
            if spec.redelivered:
                for batch in batches:
                    self._settle_deliveries(spec, source, batch)
        return counts

    def order(self) -> dict[str, int]:
        """Positions of the batches in the order of their loads, as their route snapshots build on each other."""
        known, places = self.snapshots(), {}
        for batch in sorted(known):
            chain = [batch]
            while (before := known.get(chain[-1])) in known and before not in places:
                chain.append(before)
            for name in reversed(chain):
                places.setdefault(name, places.get(known.get(name), 0) + 1)
        return places

    def _settle_deliveries(self, spec: FactSpec, source: StagingSpec, batch_id: str) -> None:
        """Mark the facts of a batch that a later one delivers again, and those of earlier ones that it delivers again;
        bring back those that only its former run displaced. Their parts of the mart follow."""
        path, facts = self.path("fact_index", spec.name), self.path("fact", spec.name)
        index = io.read_table(self.spark, path, delivery.INDEX, or_empty=True)
        former = self._written(batch_rows(index, batch_id), "former-keys")
        stored = io.read_facts(self.spark, facts, fact_schema(spec, source), None)
        kept = batch_rows(stored, batch_id).where(F.col("row_state") != io.REJECTED)
        own = delivery.index_rows(kept, spec.key, spec.date_key, self.order()[batch_id])
        new = self._written(own, "new-keys")
        for bucket in range(delivery.BUCKETS):  # what is not overwritten is gone
            io.remove(self.spark, f"{path}/bucket={bucket}/etl_batch_id={batch_id}")
        new.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket", "etl_batch_id").parquet(path)
        index = io.read_table(self.spark, path, delivery.INDEX, or_empty=True)
        keys = former.unionByName(new)
        entries = self._written(delivery.touched_entries(index, keys), "entries")
        # Facts elsewhere that share a key with this run or the former one, and own ones that are delivered later.
        cells = self._written(
            entries.where((F.col("etl_batch_id") != batch_id) | (F.col("position") < F.col("last")))
            .select("etl_batch_id", "cell").distinct(), "cells")
        there = stored.join(
            cells.withColumnRenamed("cell", spec.date_key), ["etl_batch_id", spec.date_key], "left_semi")
        # Keys that were not touched keep their state.
        seen = delivery.marked(there, spec.key, entries).join(
            entries.select(F.col("key_hash").alias("_touched")).distinct(), F.xxhash64(spec.key) == F.col("_touched"), "left")
        state = F.when((F.col("row_state") == io.REJECTED) | F.col("_touched").isNull(), F.col("row_state")).when(
            F.col("superseded"), io.SUPERSEDED).otherwise(io.ACCEPTED)
        rows = self._written(seen.withColumn("row_state", state).drop("superseded", "_touched"), "marked")
        if io.rewrite_facts(rows, cells, facts, spec.date_key) and source is TRIP:
            for (name,) in cells.select("etl_batch_id").distinct().orderBy("etl_batch_id").collect():  # one row per batch
                if name != batch_id:
                    self._write_parts(name)

    def rebook(self, batch_id: str, snapshot: str, as_of) -> dict[str, int]:
        """Bring the facts of other batches to the route versions of their days, after the snapshot changed the history.

        Only the partitions (batch, date) that hold a trip or position of a changed route on a changed day are read and
        written again; the result equals loading all batches anew. Returns the number of partitions per fact.
        """
        before = self.routes(self.snapshots().get(snapshot))
        days = self._written(timeline.changed_days(before, self.routes(snapshot)), "changed-days")
        dims, counts = self._dims(snapshot, "as_of_event"), {}
        for make_spec, source in FACTS:
            spec = make_spec()
            if not any(look.dim == "dim_route" for look in spec.lookups):
                continue
            day = F.col(spec.moment).cast("date")
            others = self.staged(source).where(F.col("etl_batch_id") != batch_id)
            on_day = (F.col("route_id") == F.col("key")) & day.between(F.col("first"), F.col("last"))
            cells = self._written(
                others.join(days, on_day, "left_semi").select("etl_batch_id", date_key(spec.moment).alias("cell")).distinct(), "cells")
            own = others.withColumn("cell", date_key(spec.moment)).join(cells, ["etl_batch_id", "cell"], "left_semi").drop("cell")
            batch = F.col("etl_batch_id")
            own = deduplicate(own) if source is VEHICLE_POSITION else own
            rows = classified_rows(own, dims, replace(spec, columns=(*spec.columns, "etl_batch_id")), "as_of_event")
            written = self._written(rows.withColumn("etl_loaded_at", ntz(as_of)), "rebooked")
            counts[spec.name] = io.rewrite_facts(written, cells, self.path("fact", spec.name), spec.date_key)
            changed = {r[0] for r in cells.select(batch).distinct().collect()}  # one row per batch
            for name in sorted(changed, key=self.order().get):
                if spec.redelivered:
                    self._settle_deliveries(spec, source, name)
                if source is TRIP:
                    self._write_parts(name)
        return counts

    # Mart ----------------------------------------------------------------------------------------------
    # Each batch has its part: sums and counts of its trips per route key and hour. A batch that is loaded again replaces
    # its part, and the mart of a date is the sum of the parts of that date, so trips of other batches are never read.

    def _parts_path(self) -> str:
        return self.path("mart_parts")

    def parts(self) -> DataFrame:
        columns = MART_SUMS | {"etl_batch_id": "string", "start_date": "date"}
        return io.read_table(self.spark, self._parts_path(), columns, or_empty=True)

    def _pending(self) -> str:
        """Where the dates of replaced parts wait until the mart has been written for them."""
        return self.path("mart_pending")

    def _write_parts(self, batch_id: str) -> None:
        """Replace the part of a batch; the dates it had before are noted first, so that no run can forget them."""
        batch_rows(self.parts(), batch_id).select("start_date").distinct().write.mode("append").parquet(self._pending())
        own = batch_rows(self.trips(), batch_id)
        sums = route_hour_sums(own).withColumn("start_date", F.col("start_hour").cast("date"))
        typed = sums.select(*(F.col(c).cast(k).alias(c) for c, k in MART_SUMS.items()), "start_date")
        typed.select("start_date").distinct().write.mode("append").parquet(self._pending())
        typed.hint("rebalance", F.col("start_date")).write.mode("overwrite").partitionBy("start_date").parquet(
            io.batch_folder(self._parts_path(), batch_id))

    def load_mart(self, batch_id: str | None, snapshot: str, as_of, version: str = "current") -> int:
        """Rewrite the mart: all of it without a batch id, else the dates that the batch changes, which gives the same rows.

        Those are the dates of its trips, of those of its former run, of rebooked trips, and of route versions that are no
        longer current. Dates that no longer have any rows are emptied.
        """
        path = self.path("mart", "trip_route_hourly")
        loaded = io.stored_batches(self.spark, self.path("fact", trip_spec().name))
        missing = set(loaded) - set(io.stored_batches(self.spark, self._parts_path()))
        for name in sorted(set(loaded) if batch_id is None else missing | {batch_id}):
            self._write_parts(name)
        if batch_id is None:
            count = io.write_mart(mart_of_sums(self.parts(), self.routes(snapshot), as_of, version), path, reload_all=True)
            io.remove(self.spark, self._pending())
            return count
        before, now = (
            scd2.current_only(self.routes(s)).select("route_sk") for s in (self.snapshots().get(snapshot), snapshot))
        closed = self.parts().join(before.join(now, "route_sk", "left_anti"), "route_sk", "left_semi").select("start_date")
        pending = io.read_table(self.spark, self._pending(), {"start_date": "date"}, or_empty=True)
        touched = self._written(pending.union(closed).distinct(), "touched")
        kept = self.parts().join(touched, "start_date", "left_semi")
        mart = self._written(mart_of_sums(kept, self.routes(snapshot), as_of, version), "mart")
        count = io.write_mart(mart, path)
        filled = mart.select(F.col("start_hour").cast("date").alias("start_date")).distinct()
        for (day,) in touched.join(filled, "start_date", "left_anti").collect():  # at most one row per day
            io.remove(self.spark, f"{path}/start_date={day}")
        io.remove(self.spark, self._pending())
        return count

    def constraints(self, batch_id: str, snapshot: str) -> DataFrame:
        """Every declared constraint with its number of violations: mandatory columns and lengths of the
        batch's staging, keys of the dimensions, and references from routes and the batch's facts. Each fact is
        read once."""
        routes = self.routes(snapshot)
        checks = [quality.staging_checks(self.staged(spec, batch_id), spec) for spec in STAGING]
        checks += [quality.duplicates(self.dim(s), [s.nat], f"{s.name} key twice") for s in DIMENSIONS]
        checks.append(quality.duplicates(routes, ["route_id_nat", "valid_from"], "dim_route key twice"))
        parents = {s.name: self.dim(s) for s in DIMENSIONS} | {"dim_route": routes}
        fare = DIM_FARE_PRODUCT
        checks.append(quality.foreign_key(
            routes, "default_fare_product_sk", parents[fare.name], fare.sk, "dim_route.default_fare_product_sk orphaned"))
        for make_spec, source in FACTS:
            spec = make_spec()
            rows = batch_rows(self.facts(spec, source), batch_id)
            known = {f"{spec.name}.{k.out} orphaned": (k.out, parents[k.dim], k.sk) for k in spec.lookups}
            known[f"{spec.name}.{spec.date_key} orphaned"] = (spec.date_key, self.calendar(), "date_key")
            checks.append(quality.references(rows, known))
        return reduce(DataFrame.unionByName, checks)

    def gates(self, snapshot: str) -> DataFrame:
        return quality.gate_counts(self.trips(), self.routes(snapshot), self.mart())


class GateFailed(RuntimeError):
    """A load that left no facts or no mart."""


def load_batch(
    spark: SparkSession, raw: str, root: str, batch_id: str, as_of, previous: str | None = None,
    reload_mart: bool = False, first: bool = False, version: str = "current", late_policy: str = "split",
) -> dict:
    """Load one batch end to end and return the row counts of every step.

    The batch builds on the ``previous`` route snapshot, by default on the latest; ``first`` starts an
    empty warehouse. Running a batch again changes nothing: staging, facts and snapshot replace the
    batch's own folders, the insert-only dimensions add only unknown members, and the mart replaces the
    dates of this and of the former run. With ``version='as_of_event'`` facts and mart follow the route
    version of the day, also when a later batch changes it. Raises ``GateFailed`` if facts or mart are empty in the end.
    """
    house = Warehouse(spark, root)
    base = house.previous_snapshot(batch_id, previous, first)
    counts: dict = {"staging": house.load_staging(raw, batch_id, as_of)}
    counts |= house.load_generated(batch_id)
    counts |= house.load_dimensions(batch_id, as_of, first)
    counts |= house.load_routes(batch_id, base, as_of, late_policy)
    counts |= house.load_facts(batch_id, batch_id, as_of, version)
    if version == "as_of_event":
        counts["rebooked"] = house.rebook(batch_id, batch_id, as_of)
    counts["mart"] = house.load_mart(None if reload_mart else batch_id, batch_id, as_of, BOOKED[version])
    counts["trips_without_hour"] = dropped_hours(batch_rows(house.trips(), batch_id)).first()["rows_without_hour"]
    gates = house.gates(batch_id).first().asDict()
    if not gates["passed"]:
        raise GateFailed(f"facts or mart are empty: {gates}")
    return counts | {"mart_stored": gates["mart_rows"]}


#: Which mart follows facts that are booked on the current or on their day's version.
BOOKED = {"current": "current", "as_of_event": "as_booked"}


def run_stage(
    house: Warehouse, name: str, batch_id: str | None, as_of, raw: str | None = None, snapshot: str | None = None,
    previous: str | None = None, first: bool = False, version: str = "current",
) -> dict:
    """One stage of a load by itself, on a batch or, without one, on all that is staged.

    Staging and routes work on one batch, as a batch is what they store. Facts and mart of all batches use the named
    snapshot, by default the batch's own.
    """
    if batch_id is None and (name in ("staging", "routes") or snapshot is None and name in ("facts", "mart")):
        raise ValueError(f"stage {name} needs a batch id" + ("" if name in ("staging", "routes") else " or a snapshot"))
    if name == "staging":
        return house.load_staging(raw, batch_id, as_of)
    if name == "generated":
        return house.load_generated(batch_id)
    if name == "dimensions":
        return house.load_dimensions(batch_id, as_of, first)
    if name == "routes":
        return house.load_routes(batch_id, house.previous_snapshot(batch_id, previous, first), as_of)
    if name == "facts":
        return house.load_facts(batch_id, snapshot or batch_id, as_of, version)
    if name == "mart":
        return {"mart": house.load_mart(batch_id, snapshot or batch_id, as_of, BOOKED[version])}
    raise ValueError(f"no stage {name!r}")


__all__ = ["GateFailed", "Warehouse", "load_batch", "run_stage", "fact_schema"]
