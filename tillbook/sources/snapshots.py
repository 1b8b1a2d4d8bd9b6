"""Versioned Parquet tables: the lake-table behaviour the jobs need, without a
lake format.

Layout under ``<root>/``:
  ``<table>/v=<n>/``      what version n of a table has written
  ``<table>/v=<n>/_manifest``  only where version n shares data with others: its folders
  ``_published/<n>``      a text file: the current version of every table

A version without a manifest is its own folder. An append writes only the new
rows, and a manifest of the folders before and its own. A keyed table
(``publish_keyed``) keeps its rows in a fixed number of buckets by a hash of the
key; ``merge_keyed`` reads and writes the buckets that hold keys of the batch, and
the manifest carries the other buckets' folders over as they are.

A publication, of one table or of several, first claims a version number for
each table by creating ``<table>/_claims/<n>`` without overwrite (two writers
cannot both claim it; a crashed writer only leaves a gap), writes the data into
a unique staging folder and renames it to ``v=<n>``. When all tables are
written, one file with the versions of all tables is written aside and renamed
to ``_published/<next>``, claimed in the same way. That rename is the only step
that readers can see: they take the highest number, so they see all tables of a
publication or none, never a half-written one, and a job can read version n
while it writes n+1. Files are accessed through the Hadoop FileSystem of the
root, i.e. the cluster's shared storage. Versions are kept until ``expire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_BUCKET = "_bucket"


class SchemaMismatch(ValueError):
    pass


class ConcurrentPublish(RuntimeError):
    pass


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list[int]:
        d = self._Path(folder)
        if not self._fs.exists(d):
            return []
        return sorted(int(st.getPath().getName()) for st in self._fs.listStatus(d) if st.getPath().getName().isdigit())

    def _claim(self, folder: str, taken: list[int]) -> int:
        number = max([-1, *taken, *self._listed(f"{folder}/_claims")]) + 1
        try:
            self._fs.create(self._Path(f"{folder}/_claims/{number}"), False).close()
        except Exception as e:  # the marker exists: another writer claimed this number first
            raise ConcurrentPublish(f"{folder}: {number} was claimed by another writer") from e
        return number

    def current_versions(self) -> dict[str, int]:
        """The current version of every published table."""
        numbers = self._listed(f"{self.root}/_published")
        if not numbers:
            return {}
        text = self._text(f"{self.root}/_published/{numbers[-1]}")        # a line per table
        return {table: int(version) for table, version in (line.rsplit(" ", 1) for line in text.splitlines())}

    def _commit(self, versions: dict[str, int]) -> None:
        folder = f"{self.root}/_published"
        published = self._listed(folder)
        if self._unfinished(folder, published):
            raise ConcurrentPublish(f"{folder}: another writer is publishing; recover() if it is gone")
        number = self._claim(folder, published)
        everything = self.current_versions() | versions
        aside = self._Path(f"{folder}/_staging-{uuid.uuid4().hex}")
        self._write_text(str(aside), [f"{t} {v}" for t, v in sorted(everything.items())])
        if not self._fs.rename(aside, self._Path(f"{folder}/{number}")):
            raise OSError(f"could not publish {sorted(versions)}")

    def _unfinished(self, folder: str, published: list[int]) -> list[int]:
        return [n for n in self._listed(f"{folder}/_claims") if n not in published and n > max([-1, *published])]

    def recover(self) -> None:
        """Give up the publications that a writer began and, being gone, will never
        finish. Their tables stay as they were."""
        folder = f"{self.root}/_published"
        for n in self._unfinished(folder, self._listed(folder)):
            self._fs.delete(self._Path(f"{folder}/_claims/{n}"), False)

    def committed_versions(self, table: str) -> list[int]:
        """The table's versions that are whole, up to the current one."""
        current = self.current_version(table)
        whole = lambda v: self._fs.exists(self._Path(f"{self.path(table, v)}/_SUCCESS"))
        return [] if current is None else [v for v in self._versions(table) if v <= current and whole(v)]

    def _versions(self, table: str) -> list[int]:
        d = self._Path(f"{self.root}/{table}")
        names = [st.getPath().getName() for st in self._fs.listStatus(d)] if self._fs.exists(d) else []
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def current_version(self, table: str) -> int | None:
        return self.current_versions().get(table)

    def exists(self, table: str) -> bool:
        return self.current_version(table) is not None

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def read(self, table: str, version: int | None = None) -> DataFrame:
        v = self.current_version(table) if version is None else version
        if v is None:
            raise FileNotFoundError(f"table {table} has no published version")
        folders = self._manifest(table, v)
        if folders is None:
            return self.spark.read.parquet(self.path(table, v))
        layout = self._layout(table, v)
        return self._read_folders(table, folders, layout[1] if layout else None)

    def _read_folders(self, table: str, folders: list[str], schema: T.StructType | None) -> DataFrame:
        """The rows in folders of a manifest (``v=0``, or ``v=0/_bucket=7`` for a bucket), all of one schema."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*(f"{self.root}/{table}/{f}" for f in folders))

    def _text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, lines: list[str]) -> None:
        out = self._fs.create(self._Path(path), False)
        out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
        out.close()

    def _manifest(self, table: str, version: int) -> list[str] | None:
        path = f"{self.path(table, version)}/_manifest"
        return self._text(path).splitlines() if self._fs.exists(self._Path(path)) else None

    def _check_schema(self, table: str, df: DataFrame, allow_schema_change: bool) -> int | None:
        cur = self.current_version(table)
        if cur is not None and not allow_schema_change:
            old = self.read(table, cur).schema
            if [(f.name, f.dataType) for f in old.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
                raise SchemaMismatch(f"{table}: schema differs from version {cur}")
        return cur

    def _stage(self, table: str, df: DataFrame, version: int, partition_by: list[str] | None = None,
               shared: list[str] | None = None) -> None:
        """Write ``df`` as the folder of a version. ``shared`` are the folders of
        other versions that belong to it too; its own follow in the manifest."""
        staging = f"{self.root}/{table}/_staging-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(staging)
        if shared is not None:
            own = [f"v={version}"]
            if partition_by == [_BUCKET]:
                names = sorted(st.getPath().getName() for st in self._fs.listStatus(self._Path(staging)))
                own = [f"v={version}/{name}" for name in names if name.startswith(f"{_BUCKET}=")]
            self._write_text(f"{staging}/_manifest", [*shared, *own])
        if not self._fs.rename(self._Path(staging), self._Path(self.path(table, version))):
            raise OSError(f"{table}: could not move version {version} into place")

    def publish(self, table: str, df: DataFrame, allow_schema_change: bool = False,
                partition_by: list[str] | None = None, mode: str = "overwrite") -> int:
        """Write ``df`` as the next version and make it current. Unless
        ``allow_schema_change``, a schema different from the current one raises.
        ``mode="append"`` makes the next version of the current rows and ``df``.
        ``partition_by`` lays the files out by those columns (e.g. a month), so
        readers filtering on them skip whole folders (partition pruning)."""
        return self.publish_many({table: df}, allow_schema_change, partition_by, mode)[table]

    def publish_many(self, tables: dict[str, DataFrame], allow_schema_change: bool = False,
                     partition_by: list[str] | None = None, mode: str = "overwrite") -> dict[str, int]:
        """Write the next version of several tables and make all of them current
        at once. Whatever fails before that leaves every table as it was."""
        versions, _ = self.stage_many(tables, allow_schema_change, partition_by, mode)
        self.commit(versions)
        return versions

    def stage_many(self, tables: dict[str, DataFrame], allow_schema_change: bool = False, partition_by: list[str] | None = None,
                   mode: str = "overwrite", metrics: dict[str, dict[str, Column]] | None = None) -> tuple[dict[str, int], dict[str, dict[str, int]]]:
        """Write the next version of several tables without making them current:
        (versions, what was counted). ``metrics`` are aggregates by table and name,
        taken of the new rows while they are written, next to ``n_rows``.
        ``commit`` makes the versions current, ``abandon`` deletes them."""
        if mode not in ("overwrite", "append"):
            raise ValueError(f"unknown mode {mode!r}")
        versions, counted = {}, {}
        for t, df in tables.items():
            current = self._check_schema(t, df, allow_schema_change)
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *(m.alias(name) for name, m in (metrics or {}).get(t, {}).items()))
            shared = None
            if mode == "append" and current is not None:
                old = self.read(t, current)
                folders = self._manifest(t, current) or [f"v={current}"]
                if any(f"/{_BUCKET}=" in f for f in folders):
                    raise ValueError(f"{t} is keyed: use merge_keyed")
                if partition_by is None and old.schema.names == df.schema.names and self._flat(t, folders):
                    shared = folders             # the old rows stay where they are
                else:
                    df = old.unionByName(df, allowMissingColumns=allow_schema_change)
            versions[t] = self._claim(f"{self.root}/{t}", self._versions(t))
            self._stage(t, df, versions[t], partition_by, shared)
            counted[t] = seen.get
        return versions, counted

    def commit(self, versions: dict[str, int]) -> None:
        """Make staged versions current, all at once."""
        self._commit(versions)

    def abandon(self, versions: dict[str, int]) -> None:
        """Delete staged versions that will not become current."""
        for t, v in versions.items():
            if self.current_version(t) != v:
                self._fs.delete(self._Path(self.path(t, v)), True)

    def _flat(self, table: str, folders: list[str]) -> bool:
        """Whether no folder is laid out by columns."""
        return not any(st.isDirectory() for f in folders for st in self._fs.listStatus(self._Path(f"{self.root}/{table}/{f}")))

    # ------------------------------------------------------------ keyed tables
    def publish_keyed(self, table: str, df: DataFrame, key: str, buckets: int = 64, allow_schema_change: bool = False) -> int:
        """Write ``df`` as the next version of a table in ``buckets`` folders by a
        hash of the integer or text column ``key``, and make it current. Rows with
        a null key have a bucket like others."""
        self._check_schema(table, df, allow_schema_change)
        return self._publish_buckets(table, df, key, buckets, [])

    def _publish_buckets(self, table: str, df: DataFrame, key: str, buckets: int, shared: list[str]) -> int:
        version = self._claim(f"{self.root}/{table}", self._versions(table))
        # a bucket is written by one task, or by several if it is large
        self._stage(table, _bucketed(df, key, buckets).hint("rebalance", _BUCKET), version, [_BUCKET], shared)
        self._write_text(f"{self.path(table, version)}/_layout", [str(buckets), df.schema.json()])
        self.commit({table: version})
        return version

    def merge_keyed(self, table: str, batch: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Copy on write: ``merge(current rows, batch)`` of the buckets that the
        batch has keys of becomes the next version, together with all other
        buckets' folders, which are neither read nor written. ``merge`` must keep
        each row's key and add only keys of the batch. A number per bucket is all
        that passes the driver."""
        current = self.current_version(table)
        if current is None:
            raise FileNotFoundError(f"table {table} has no published version")
        layout = self._layout(table, current)
        if layout is None:
            raise ValueError(f"{table} is not keyed: publish_keyed lays it out by key")
        buckets, schema = layout
        touched = _touched(batch, key, buckets)
        folders = {int(f.rsplit("=", 1)[1]): f for f in self._manifest(table, current)}
        rows = self._read_folders(table, [f for b, f in folders.items() if b in touched], schema)
        merged = merge(rows, batch)
        if [(f.name, f.dataType) for f in merged.schema.fields] != [(f.name, f.dataType) for f in schema.fields]:
            raise SchemaMismatch(f"{table}: the merge gives another schema than version {current}")
        return self._publish_buckets(table, merged, key, buckets, [f for b, f in folders.items() if b not in touched])

    def bucket_count(self, table: str) -> int:
        return self._layout(table, self.current_version(table))[0]

    def read_buckets(self, table: str, batch: DataFrame, key: str, version: int | None = None) -> DataFrame:
        """The rows of a keyed table in the buckets that hold keys of ``batch``; no other is read."""
        v = self.current_version(table) if version is None else version
        layout = None if v is None else self._layout(table, v)
        if layout is None:
            raise ValueError(f"{table} is not keyed: publish_keyed lays it out by key")
        touched = _touched(batch, key, layout[0])
        return self._read_folders(table, [f for f in self._manifest(table, v) if int(f.rsplit("=", 1)[1]) in touched], layout[1])

    def differing(self, table: str, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The rows of two versions (until: the current one) without the folders
        that both share, which hold the same rows and are not read. What an
        append adds and what a merge rewrites is all that there is, so
        ``row_changes`` of the two frames costs as much as the change."""
        until = self.current_version(table) if until is None else until
        old, new = (self._manifest(table, v) or [f"v={v}"] for v in (since, until))
        frames = []
        for v, own, other in ((since, old, new), (until, new, old)):
            layout = self._layout(table, v)
            frames.append(self._read_folders(table, [f for f in own if f not in other], layout[1] if layout else self.read(table, v).schema))
        return frames[0], frames[1]

    def _layout(self, table: str, version: int) -> tuple[int, T.StructType] | None:
        """The number of buckets and the schema of a keyed version."""
        path = f"{self.path(table, version)}/_layout"
        if not self._fs.exists(self._Path(path)):
            return None
        buckets, schema = self._text(path).splitlines()
        return int(buckets), T.StructType.fromJson(json.loads(schema))

    def expire(self, table: str, keep: int) -> None:
        """Delete what only versions before the newest ``keep`` use: their folders,
        or those that no kept manifest names. Nothing else deletes a version's
        data: call it when no reader uses the older ones."""
        if keep < 1:
            raise ValueError("at least the current version is kept")
        versions = self.committed_versions(table)
        used = {f for v in versions[-keep:] for f in (self._manifest(table, v) or [f"v={v}"])}
        for v in versions[:-keep]:
            if f"v={v}" in used:
                continue
            own = [f for f in used if f.startswith(f"v={v}/")]
            if not own:
                self._fs.delete(self._Path(self.path(table, v)), True)
                continue
            for st in self._fs.listStatus(self._Path(self.path(table, v))):
                if f"v={v}/{st.getPath().getName()}" not in own:
                    self._fs.delete(st.getPath(), True)


def _touched(batch: DataFrame, key: str, buckets: int) -> set[int]:
    return {r[0] for r in _bucketed(batch.select(key), key, buckets).select(_BUCKET).distinct().collect()}   # at most one a bucket


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with the number of each row's bucket."""
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
