"""Tables kept as versions in a folder: written with DataFrame writers, read as of any version.

``log/version=N`` holds what version N changed, ``snapshots/version=N`` whole tables made by compaction, and
``history`` a row per commit. A version counts once its history row is there, which is written last, so a half-written
version is not seen and a repeated one replaces itself. There is one writer at a time: no locks, no
transaction log.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators import lake
from weftline.schemas import schema_difference

HISTORY = (
    "version long, kind string, operation string, parameters map<string,string>, commit_ts timestamp, "
    "rows_read long, rows_written long, rows_updated long, rows_deleted long, written_at timestamp"
)
_COUNTS = ("rows_read", "rows_written", "rows_updated", "rows_deleted")


@dataclass(frozen=True)
class VersionedTable:
    """A table of the given schema; with ``keys`` a key has one row, and rows with null keys are refused."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()

    # ---- reading ----

    def _events(self) -> DataFrame:
        """The last history row of each version and kind, as repeated writes leave several."""
        try:
            rows = self.spark.read.schema(HISTORY).parquet(f"{self.path}/history")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], HISTORY)
        names = [c for c in rows.columns if c not in ("version", "kind")]
        last = rows.groupBy("version", "kind").agg(F.max_by(F.struct(*names), "written_at").alias("row"))
        return last.select("version", "kind", "row.*").drop("written_at")

    def history(self) -> DataFrame:
        """Per version: operation, parameters, commit time, and the rows it read, wrote, updated and deleted."""
        return self._events().filter("kind = 'commit'").drop("kind")

    def latest(self, as_of: datetime.datetime | None = None) -> int | None:
        """The newest version, or the newest committed at ``as_of``; None if there is none."""
        rows = self.history() if as_of is None else self.history().filter(F.col("commit_ts") <= F.lit(as_of))
        return rows.agg(F.max("version")).first()[0]

    def read(self, version: int | None = None, as_of: datetime.datetime | None = None) -> DataFrame:
        """The table at a version, by default the newest, or at a commit time.

        Starts from the newest snapshot or overwriting version and looks at no older file.
        """
        wanted = self.latest(as_of) if version is None and as_of is not None else version
        if wanted is None and as_of is not None:
            return self.spark.createDataFrame([], self.schema)
        events = self._events() if wanted is None else self._events().filter(F.col("version") <= wanted)
        events = events.select("version", "kind", "operation").collect()
        return self._at(events)

    def _at(self, events: list) -> DataFrame:
        """The table after the given commits and compactions."""
        committed = {e.version for e in events if e.kind == "commit"}
        whole = max((e.version for e in events if e.kind == "commit" and e.operation == "OVERWRITE"), default=None)
        packed = max((e.version for e in events if e.kind == "compaction" and e.version in committed), default=None)
        first = max((v for v in (whole, packed) if v is not None), default=None)
        from_snapshot = packed is not None and packed == first
        versions = [v for v in committed if first is None or v > first or (v == first and not from_snapshot)]
        parts = []
        if from_snapshot:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/version={packed}")
            parts.append(rows.withColumn("op", F.lit("put")).withColumn("version", F.lit(packed).cast("long")))
        if versions:
            kind = T.StructType([*self.schema.fields, T.StructField("op", T.StringType())])
            for_version = lambda v: self.spark.read.schema(kind).parquet(f"{self.path}/log/version={v}")
            parts.extend(for_version(v).withColumn("version", F.lit(v).cast("long")) for v in sorted(versions))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        entries = parts[0]
        for part in parts[1:]:
            entries = entries.unionByName(part)
        if not self.keys:
            return entries.select(*self.schema.names)
        if len(parts) == 1:
            return entries.filter(F.col("op") != "delete").select(*self.schema.names)
        data = [c for c in self.schema.names if c not in self.keys]
        last = entries.groupBy(*self.keys).agg(F.max_by(F.struct("op", *data), "version").alias("row"))
        there = last.filter(F.col("row.op") != "delete")
        return there.select(*self.keys, *[f"row.{c}" for c in data]).select(*self.schema.names)

    # ---- writing ----

    def append(self, rows: DataFrame, version: int | None = None, at: datetime.datetime | None = None) -> int:
        """Add rows; with keys, rows of known keys replace them (an upsert)."""
        return self._put(rows, "APPEND" if not self.keys else "MERGE", version, at)

    def overwrite(self, rows: DataFrame, version: int | None = None, at: datetime.datetime | None = None) -> int:
        """Replace the whole table; older versions can still be read."""
        return self._put(rows, "OVERWRITE", version, at)

    def update(
        self, condition: str, values: Mapping[str, str], version: int | None = None, at: datetime.datetime | None = None
    ) -> int:
        """Set columns to SQL expressions where the condition is true; only changed rows are written."""
        hit = F.coalesce(F.expr(condition), F.lit(False))
        parameters = {"predicate": condition, **{f"set {c}": v for c, v in sorted(values.items())}}
        changed = {c: F.expr(v).cast(self.schema[c].dataType) for c, v in values.items()}
        number = self._next(version)
        if set(values) & set(self.keys):
            raise ValueError("an update cannot change a key")
        rows = self.read(number - 1)
        counts = {"rows_read": F.count(F.lit(1)), "rows_updated": F.count_if(hit)}
        if self.keys:
            return self._write(rows, counts, lambda r: lake.update(r.filter(hit), F.lit(True), changed), "put", "UPDATE", parameters, number, at)
        return self._write(rows, counts, lambda r: lake.update(r, hit, changed), "put", "UPDATE", parameters, number, at, True)

    def delete(self, condition: str, version: int | None = None, at: datetime.datetime | None = None) -> int:
        """Remove rows where the condition is true."""
        hit = F.coalesce(F.expr(condition), F.lit(False))
        number = self._next(version)
        counts = {"rows_read": F.count(F.lit(1)), "rows_deleted": F.count_if(hit)}
        given = {"predicate": condition}
        if self.keys:
            return self._write(self.read(number - 1), counts, lambda r: r.filter(hit), "delete", "DELETE", given, number, at)
        return self._write(self.read(number - 1), counts, lambda r: r.filter(~hit), "put", "DELETE", given, number, at, True)

    def compact(self, version: int | None = None) -> int:
        """Write the table of a version as a snapshot, from which it and later versions are then read."""
        number = self.latest() if version is None else version
        if number is None:
            raise ValueError("there is no version to compact")
        self.read(number).write.mode("overwrite").parquet(f"{self.path}/snapshots/version={number}")
        self._commit(number, "compaction", "COMPACT", {}, {}, None)
        return number

    def _next(self, version: int | None) -> int:
        newest = self.latest()
        if version is None:
            return 0 if newest is None else newest + 1
        if newest is not None and version < newest:
            raise ValueError(f"version {version} lies before the newest, {newest}")
        return version

    def _put(self, rows: DataFrame, operation: str, version: int | None, at: datetime.datetime | None) -> int:
        problems = schema_difference(rows.schema, self.schema)
        if problems:
            raise ValueError("cannot write: " + "; ".join(problems))
        rows = rows.select(*self.schema.names)
        if self.keys:
            whole = F.lit(True)
            for key in self.keys:
                whole = whole & F.col(key).isNotNull()
            rows = rows.filter(F.assert_true(whole, "a key is null").isNull())
            rows = lake.one_row_per_key(rows, list(self.keys))
        counts = {"rows_written": F.count(F.lit(1))}
        return self._write(rows, counts, lambda r: r, "put", operation, {}, self._next(version), at, operation == "OVERWRITE")

    def _write(
        self,
        rows: DataFrame,
        counts: Mapping[str, Column],
        change,
        op: str,
        operation: str,
        parameters: Mapping[str, str],
        version: int,
        at: datetime.datetime | None,
        whole: bool = False,
    ) -> int:
        """Write ``change(rows)`` as a version, counting ``rows`` in the same pass and stage."""
        seen, made = Observation(), Observation()
        changed = change(rows.observe(seen, *(c.alias(n) for n, c in counts.items())))
        changed = changed.withColumn("op", F.lit(op)).observe(made, F.count(F.lit(1)).alias("n"))
        changed.write.mode("overwrite").parquet(f"{self.path}/log/version={version}")
        found = dict(seen.get)
        found["rows_written"] = made.get["n"] if op == "put" else 0
        kind = "OVERWRITE" if whole else operation
        if kind != operation:
            parameters = {"operation": operation, **parameters}
        self._commit(version, "commit", kind, parameters, found, at)
        return version

    def _commit(self, version, kind, operation, parameters, counts, at) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        row = (version, kind, operation, dict(parameters), at or now, *(counts.get(c, 0) for c in _COUNTS), now)
        self.spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(f"{self.path}/history")
