"""Tables in versions: atomic publish, keyed loads and expiry.

A table folder holds data folders that are written once and never changed or renamed, and
``_versions/<n>.json`` manifests.  A manifest lists the folders of one version (those of a
bucketed or dated table by value, with their row counts), its schema and its settings.
A change writes its data first, then its manifest under a temporary name, and last links
that to the next number, which fails if the number is taken (compare-and-swap).  Until
then readers resolve the old version, afterwards the new one; a crash at any step leaves
unreferenced files that ``vacuum`` removes.  A writer that lost the race starts
again from the version it lost to.

Keyed tables (``insert_if_absent``, ``upsert``) are laid out in key-hash buckets.  Every
folder of rows stores a Bloom filter per bucket in an index table, so a load looks for its
keys in the filters first and reads only the buckets that may hold one of them.

Manifests reach the driver: one entry per folder, with one number per bucket or date
partition of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.operators.dedup import last_wins
from lapsewise.session import materialize

BUCKET = "_bucket"
PERIOD = "_period"
#: Bits of one stored bitmap and bits a key, and how many of them a key sets.
SEGMENT_BITS = 32768
BITS_PER_KEY = 12
PROBES = 5
#: How often a change is tried against a table that others change.
ATTEMPTS = 5


class Conflict(RuntimeError):
    """Another writer has published the version this change was based on."""


@dataclass
class Snapshot:
    """One version: ``parts`` are {dir, by, values {value: rows}, index}."""

    version: int = 0
    schema: T.StructType | None = None
    parts: list[dict] = field(default_factory=list)
    settings: dict = field(default_factory=dict)
    operation: str = "none"

    def as_json(self) -> str:
        return json.dumps({"version": self.version, "operation": self.operation, "schema": self.schema.jsonValue(),
                           "settings": self.settings, "parts": self.parts})

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        got = json.loads(text)
        return cls(got["version"], T.StructType.fromJson(got["schema"]), got["parts"], got["settings"], got["operation"])

    def rows(self) -> int:
        return sum(sum(p["values"].values()) for p in self.parts)

    def without(self, values: set[str]) -> list[dict]:
        """The parts but for the given buckets or periods."""
        left = [{**p, "values": {v: n for v, n in p["values"].items() if v not in values}} for p in self.parts]
        return [p for p in left if p["values"]]


@dataclass
class Staged:
    """A batch ready for ``insert``: its rows by key, and those absent from ``version``."""

    rows: DataFrame
    absent: DataFrame
    version: int
    settings: dict
    rows_read: int
    buckets_read: list[str]


def is_versioned(spark: SparkSession, path: str) -> bool:
    from lapsewise.operators.loading import path_exists

    return path_exists(spark, f"{path.rstrip('/')}/_versions")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        from lapsewise.operators.loading import hadoop_fs

        fs, folder = hadoop_fs(self.spark, f"{self.path}/_versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, version: int) -> str:
        return f"{self.path}/_versions/{version:012d}.json"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given version, else the newest; version 0 is an empty table."""
        from lapsewise.operators.loading import hadoop_fs

        if version is None:
            version = (self.versions() or [0])[-1]
        if not version:
            return Snapshot()
        fs, p = hadoop_fs(self.spark, self._manifest(version))
        stream = fs.open(p)
        try:
            return Snapshot.from_json(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.versions())

    def _stage_manifest(self, text: str) -> str:
        from lapsewise.operators.loading import hadoop_fs

        staged = f"{self.path}/_versions/.{uuid.uuid4().hex}.tmp"
        fs, p = hadoop_fs(self.spark, staged)
        out = fs.create(p, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return staged

    def _publish(self, staged: str, version: int) -> None:
        """Give the staged manifest its number, unless that is taken."""
        from py4j.protocol import Py4JJavaError

        from lapsewise.operators.loading import hadoop_fs

        sc = self.spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
        fs, final = hadoop_fs(self.spark, self._manifest(version))
        source = jvm.org.apache.hadoop.fs.Path(staged)
        try:
            if fs.getUri().getScheme() == "file":
                # a hard link never replaces a file
                local = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (final, source)]
                jvm.java.nio.file.Files.createLink(*local)
            else:
                none = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(source, final, none)
        except Py4JJavaError as exc:
            if "AlreadyExists" in exc.java_exception.getClass().getName():
                raise Conflict(f"version {version} of {self.path} is taken") from exc
            raise
        finally:
            fs.delete(source, False)

    def _commit(self, base: Snapshot, schema: T.StructType, parts: list[dict], operation: str, settings: dict) -> Snapshot:
        new = Snapshot(base.version + 1, schema, parts, settings, operation)
        self._publish(self._stage_manifest(new.as_json()), new.version)
        return new

    def _retrying(self, change: Callable[[Snapshot], object]):
        for attempt in range(ATTEMPTS):
            try:
                return change(self.snapshot())
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise

    # ---------------------------------------------------------------- data
    def read(self, version: int | None = None, values: Sequence[str] | None = None) -> DataFrame:
        """The table as of one version, resolved now; ``values``: only those buckets or periods."""
        return self._read(self.snapshot(version), values)

    def _folders(self, snap: Snapshot, values: Sequence[str] | None = None) -> list[str]:
        folders = []
        for p in snap.parts:
            if p["by"] is None:
                folders.append(f"{self.path}/{p['dir']}")
            else:
                held = sorted(p["values"]) if values is None else [v for v in sorted(values) if v in p["values"]]
                folders += [f"{self.path}/{p['dir']}/{p['by']}={v}" for v in held]
        return folders

    def _read(self, snap: Snapshot, values: Sequence[str] | None = None) -> DataFrame:
        if snap.schema is None:
            raise FileNotFoundError(f"{self.path} has no version")
        folders = self._folders(snap, values)
        df = self.spark.read.schema(snap.schema).parquet(*folders) if folders else self.spark.createDataFrame([], snap.schema)
        if values is None:
            df.counted_rows = snap.rows()  # counted when they were written
        return df

    def _write_part(self, df: DataFrame, by: str | None) -> dict:
        """Rows into a folder of their own; one sub-folder a value of ``by``."""
        folder = f"data/{uuid.uuid4().hex}"
        if by is None:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(f"{self.path}/{folder}")
            return {"dir": folder, "by": None, "values": {"": int(seen.get["n"])}, "index": None}
        df.write.mode("errorifexists").partitionBy(by).parquet(f"{self.path}/{folder}")
        part = {"dir": folder, "by": by, "values": {}, "index": None}
        # a count by folder: footers alone
        for r in self._whole(part, df.schema).groupBy(by).count().collect():
            part["values"][r[by]] = r["count"]
        return part

    def _whole(self, part: dict, schema: T.StructType) -> DataFrame:
        """All rows of a part, the folder value as a string column."""
        fields = [f for f in schema.fields if f.name != part["by"]] + [T.StructField(part["by"], T.StringType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{part['dir']}")

    # -------------------------------------------------------------- reload
    def replace(self, df: DataFrame, validate: Callable[[DataFrame], None] | None = None, settings: dict | None = None,
                by: str | None = None, operation: str = "replace") -> DataFrame:
        """Truncate and reload: the rows of ``df`` become the next version.

        ``validate`` sees the written rows; if it raises, the old version stays.
        """
        schema = T.StructType([f for f in df.schema.fields if f.name != by])
        part = self._write_part(df, by)
        staged = Snapshot(0, schema, [part] if part["values"] else [], settings or {}, operation)
        if validate is not None:
            validate(self._read(staged))

        def change(base: Snapshot):
            return self._commit(base, schema, staged.parts, operation, settings if settings is not None else base.settings)

        return self._read(self._retrying(change))

    # --------------------------------------------------------- keyed loads
    def _settings(self, base: Snapshot, keys: list[str], buckets: int | None) -> dict:
        if base.version == 0 or not base.settings.get("keys"):
            if base.parts:
                raise ValueError(f"{self.path} was not created with keys")
            return {**base.settings, "keys": keys, "buckets": buckets or 16}
        if base.settings["keys"] != keys:
            raise ValueError(f"{self.path} is keyed by {base.settings['keys']}, not {keys}")
        if buckets is not None and base.settings["buckets"] != buckets:
            raise ValueError(f"{self.path} has {base.settings['buckets']} buckets, not {buckets}")
        return base.settings

    def _keyed(self, df: DataFrame, settings: dict) -> DataFrame:
        hashed = F.xxhash64(*settings["keys"])
        return df.withColumn(BUCKET, F.pmod(hashed, F.lit(settings["buckets"])).cast("int"))

    def _write_keyed(self, rows: DataFrame, settings: dict) -> dict:
        """Bucketed rows and their filters.  Ranges of (bucket, key hash): a large bucket is
        written by several tasks."""
        part = self._write_part(rows.repartitionByRange(BUCKET, F.xxhash64(*settings["keys"])), BUCKET)
        if part["values"]:
            # whole segments for the fullest bucket
            part["bits"] = SEGMENT_BITS * -(-max(part["values"].values()) * BITS_PER_KEY // SEGMENT_BITS)
            part["index"] = self._write_index(part, rows.schema, settings)
        return part

    def _write_index(self, part: dict, schema: T.StructType, settings: dict) -> str:
        folder = f"index/{uuid.uuid4().hex}"
        rows = self._whole(part, schema).select(F.col(BUCKET).cast("int").alias(BUCKET), *settings["keys"])
        bits = rows.select(BUCKET, F.explode(_probes(settings["keys"], part["bits"])).alias("at"))
        bits.groupBy(BUCKET, _segment("at").alias("segment")).agg(
            F.bitmap_construct_agg(F.pmod("at", F.lit(SEGMENT_BITS))).alias("bits")).write.parquet(f"{self.path}/{folder}")
        return folder

    def _maybe_present(self, rows: DataFrame, snap: Snapshot, settings: dict) -> DataFrame:
        """``rows`` (with buckets) that a stored filter does not rule out: no key that the table
        holds is missing, a few others are there as well."""
        found = None
        keys = settings["keys"]
        for part in snap.parts:
            if not part["index"]:
                raise ValueError(f"{self.path}/{part['dir']} has no key index")
            index = self.spark.read.parquet(f"{self.path}/{part['index']}").where(
                F.col(BUCKET).isin([int(v) for v in part["values"]]))
            probes = F.array_distinct(_probes(keys, part["bits"]))
            asked = rows.select(*keys, BUCKET, F.explode(probes).alias("at")).withColumn("segment", _segment("at"))
            hit = asked.join(index, [BUCKET, "segment"]).where(_bit("bits", F.pmod("at", F.lit(SEGMENT_BITS))) == 1)
            need = F.size(F.array_distinct(_probes(keys, part["bits"])))
            full = hit.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") == need).select(*keys)
            found = full if found is None else found.unionByName(full)
        return found.distinct()

    def _absent(self, staged: DataFrame, snap: Snapshot, settings: dict) -> tuple[DataFrame, list[str]]:
        """Staged rows whose key the table lacks, and the buckets that had to be read."""
        if not snap.parts:
            return staged, []
        keys = settings["keys"]
        maybe = materialize(self._keyed(self._maybe_present(staged, snap, settings), settings), "maybe_present")
        read = sorted(str(r[0]) for r in maybe.select(BUCKET).distinct().collect())
        if not read:
            return staged, []
        existing = self._read(snap, read).select(*keys)
        present = maybe.join(existing, keys, "left_semi").select(*keys)
        return staged.join(present, keys, "left_anti"), read

    def stage(self, batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
              drop: Sequence[str] = (), buckets: int | None = None) -> Staged:
        """The first row of each key of ``batch`` that the table lacks, written to the work
        folder for ``insert``.  A NULL key is refused."""
        from lapsewise.operators.loading import rows_absent

        keys = list(keys)
        seen = Observation()
        base = self.snapshot()
        settings = self._settings(base, keys, buckets)
        batch = batch.observe(seen, F.count(F.lit(1)).alias("n"))
        rows = materialize(self._keyed(rows_absent(batch, None, keys, order, drop), settings), "keyed_batch")
        if not rows.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).isEmpty():
            raise ValueError(f"NULL in the key ({', '.join(keys)}) of rows for {self.path}")
        if base.schema is not None:
            rows = rows.select(*base.schema.names, BUCKET)
        absent, read = self._absent(rows, base, settings)
        if base.parts and read:
            absent = materialize(absent, "absent_rows")
        return Staged(rows, absent, base.version, settings, int(seen.get["n"]), read)

    def insert(self, staged: Staged) -> dict:
        """Publish staged rows.  Returns rows_read, rows_inserted and the buckets whose rows were read."""

        def change(base: Snapshot):
            held = self._settings(base, staged.settings["keys"], staged.settings["buckets"])
            new, read = staged.absent, staged.buckets_read
            if base.version != staged.version:
                new, read = self._absent(staged.rows, base, held)
            schema = base.schema or T.StructType([f for f in staged.rows.schema.fields if f.name != BUCKET])
            part = self._write_keyed(new.select(*schema.names, BUCKET), held)
            n = sum(part["values"].values())
            if n or not base.version:
                self._commit(base, schema, base.parts + ([part] if n else []), "insert", held)
            return {"rows_read": staged.rows_read, "rows_inserted": n, "buckets_read": read}

        return self._retrying(change)

    def insert_if_absent(self, batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                         drop: Sequence[str] = (), buckets: int | None = None) -> dict:
        """Add the first row of each key the table lacks; rows it has never change."""
        return self.insert(self.stage(batch, keys, order, drop, buckets))

    def upsert(self, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[str], buckets: int | None = None) -> DataFrame:
        """Insert new keys, replace rows by newer ones; only the buckets that the batch touches
        are read and written again, all published by one manifest."""
        keys = list(keys)
        settings = self._settings(self.snapshot(), keys, buckets)
        staged = materialize(self._keyed(last_wins(batch, keys, newest_first), settings), "keyed_batch")
        touched = sorted(str(r[0]) for r in staged.select(BUCKET).distinct().collect())

        def change(base: Snapshot):
            held = self._settings(base, keys, settings["buckets"])
            schema = base.schema or T.StructType([f for f in staged.schema.fields if f.name != BUCKET])
            merged = staged.select(*schema.names, BUCKET)
            if base.parts:
                old = self._keyed(self._read(base, touched), held)
                merged = last_wins(old.unionByName(merged), keys, newest_first)
            if not touched and base.version:
                return base
            part = self._write_keyed(merged, held)
            return self._commit(base, schema, base.without(set(touched)) + ([part] if part["values"] else []), "upsert", held)

        return self._read(self._retrying(change))

    def merge(self, batch: DataFrame, keys: Sequence[str], how: dict[str, str], name: str, buckets: int | None = None) -> DataFrame:
        """Merge measures by key: ``how`` says for each column whether two rows add up
        ('sum') or the least or greatest stays ('min', 'max'); the result keeps a column's
        type.  ``name`` identifies the batch; one that was merged before changes nothing."""
        keys = list(keys)
        merge = {"sum": F.sum, "min": F.min, "max": F.max}

        def merged(df: DataFrame, schema: T.StructType) -> DataFrame:
            return df.groupBy(*keys).agg(*[merge[h](c).cast(schema[c].dataType).alias(c) for c, h in how.items()])

        staged = None

        def change(base: Snapshot):
            nonlocal staged
            held = self._settings(base, keys, buckets)
            if name in base.settings.get("batches", []):
                return base
            if staged is None:
                staged = materialize(self._keyed(merged(batch, batch.schema), held), "keyed_batch")
            touched = sorted(str(r[0]) for r in staged.select(BUCKET).distinct().collect())
            schema = base.schema or T.StructType([f for f in staged.schema.fields if f.name != BUCKET])
            rows = staged.select(*schema.names)
            if base.parts and touched:
                rows = merged(self._read(base, touched).unionByName(rows), schema)
            part = self._write_keyed(self._keyed(rows.select(*schema.names), held), held)
            parts = base.without(set(touched)) + ([part] if part["values"] else [])
            return self._commit(base, schema, parts, f"merge {name}", {**held, "batches": [*held.get("batches", []), name]})

        return self._read(self._retrying(change))

    def compact(self) -> Snapshot:
        """All folders of a keyed table in one, with one filter a bucket."""

        def change(base: Snapshot):
            if len(base.parts) <= 1:
                return base
            part = self._write_keyed(self._keyed(self._read(base), base.settings), base.settings)
            return self._commit(base, base.schema, [part], "compact", base.settings)

        return self._retrying(change)

    # -------------------------------------------------------------- expiry
    def append_dated(self, df: DataFrame, date_col: str) -> Snapshot:
        """Add rows, laid out by month of ``date_col`` (rows without a date: month 'none')."""
        month = F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit("none"))
        laid = df.withColumn(PERIOD, month).repartitionByRange(PERIOD, F.xxhash64(*df.columns))
        part = self._write_part(laid, PERIOD)

        def change(base: Snapshot):
            if base.version and base.settings.get("date") != date_col:
                raise ValueError(f"{self.path} is not laid out by {date_col}")
            return self._commit(base, base.schema or df.schema, base.parts + ([part] if part["values"] else []), "append",
                                {**base.settings, "date": date_col})

        return self._retrying(change)

    def read_dates(self, start: str, end: str) -> DataFrame:
        """Rows dated from ``start`` to ``end`` (inclusive): only those months' folders are read."""
        snap = self.snapshot()
        months = {v for p in snap.parts for v in p["values"] if start[:7] <= v <= end[:7]}
        return self._read(snap, sorted(months)).where(F.col(snap.settings["date"]).between(F.lit(start).cast("date"), F.lit(end).cast("date")))

    def expire(self, before: str) -> DataFrame:
        """Remove rows dated before ``before`` (YYYY-MM-DD); returns what was removed.

        Whole months leave the manifest unread; the month of ``before`` is written again
        without its older rows.  Rows without a date stay.  One row a month (period, rows_removed,
        how) is logged; the version that removes the rows names its log (see ``expired``).
        """
        limit = F.lit(before).cast("date")

        def change(base: Snapshot):
            gone, border = {}, before[:7]
            for p in base.parts:
                for v, n in p["values"].items():
                    if v < border:  # 'none' sorts after every month
                        gone[v] = gone.get(v, 0) + n
            parts = base.without(set(gone) | {border})
            removed = [(v, n, "dropped") for v, n in sorted(gone.items())]
            held = sum(p["values"].get(border, 0) for p in base.parts)
            if held:
                old = self._read(base, [border])
                column = F.col(base.settings["date"])
                kept = old.where(column >= limit).withColumn(PERIOD, F.lit(border))
                part = self._write_part(kept, PERIOD)
                left = part["values"].get(border, 0)
                if left == held:
                    parts = base.without(set(gone))  # nothing of the month has expired
                else:
                    parts = parts + ([part] if left else [])
                    removed.append((border, held - left, "rewritten"))
            log = self.spark.createDataFrame(
                [(base.version + 1, before, *r) for r in removed],
                "version long, before string, period string, rows_removed long, how string")
            if removed:
                name = f"expired/{uuid.uuid4().hex}"
                log.write.parquet(f"{self.path}/{name}")
                settings = {**base.settings, "expired": [*base.settings.get("expired", []), name]}
                self._commit(base, base.schema, parts, f"expire before {before}", settings)
            return log

        return self._retrying(change)

    def expired(self) -> DataFrame:
        """The log of all removals: version, before, period, rows_removed, how."""
        names = self.snapshot().settings.get("expired", [])
        schema = "version long, before string, period string, rows_removed long, how string"
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    # -------------------------------------------------------------- vacuum
    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete older manifests than the last ``keep`` and the folders that only they (or no
        version at all) name.  Run it while nobody writes or reads older versions."""
        from lapsewise.operators.loading import hadoop_fs

        numbers = self.versions()
        kept = [self.snapshot(n) for n in numbers[-keep:]]
        named = {p[k] for s in kept for p in s.parts for k in ("dir", "index") if p[k]}
        removed = []
        for n in numbers[:-keep]:
            fs, p = hadoop_fs(self.spark, self._manifest(n))
            fs.delete(p, False)
        for kind in ("data", "index"):
            fs, folder = hadoop_fs(self.spark, f"{self.path}/{kind}")
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                name = f"{kind}/{status.getPath().getName()}"
                if name not in named:
                    fs.delete(status.getPath(), True)
                    removed.append(name)
        return sorted(removed)


def _probes(keys: Sequence[str], bits: int) -> F.Column:
    """The bits that a key sets, by double hashing."""
    a, b = F.xxhash64(F.lit(1), *keys), F.xxhash64(F.lit(2), *keys)
    half = lambda h: F.shiftrightunsigned(h, 32)
    return F.array(*[F.pmod(half(a) + F.lit(i) * (half(b) + F.lit(1)), F.lit(bits).cast("long")) for i in range(PROBES)])


def _segment(at: str) -> F.Column:
    return F.floor(F.col(at) / F.lit(SEGMENT_BITS)).cast("int")


def _bit(bits: str, at) -> F.Column:
    """Bit ``at`` of a binary bitmap (least significant first in its byte)."""
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1))


__all__ = ["Conflict", "Snapshot", "VersionedTable", "is_versioned"]
