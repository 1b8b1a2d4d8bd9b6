"""Schema snapshots and drift detection.

A schema snapshot is a small DataFrame (table, column, data_type, nullable)
built from ``df.schema`` — metadata whose size is the column count, never the
row count. Drift compares the current snapshot with the previous one by
column name and type (order and nullability are reported but do not count
as drift, as in the original check). ``nested_drift`` also looks into structs,
arrays and maps and tells whether a changed type still holds every old value.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
    T.StructField("position", T.IntegerType(), False),
])


def schema_snapshot(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def schema_drift(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Rows (table_name, column_name, change, previous_type, current_type) with
    change in {'new', 'missing', 'type_changed'}; no rows = no drift. With no
    previous snapshot (first run) every column is reported as 'baseline'."""
    if previous is None:
        return current.select("table_name", "column_name", F.lit("baseline").alias("change"),
                              F.lit(None).cast("string").alias("previous_type"),
                              F.col("data_type").alias("current_type"))
    c = current.alias("c")
    p = previous.alias("p")
    j = c.join(p, (F.col("c.table_name") == F.col("p.table_name")) & (F.col("c.column_name") == F.col("p.column_name")),
               "full_outer")
    change = (F.when(F.col("p.column_name").isNull(), "new")
              .when(F.col("c.column_name").isNull(), "missing")
              .when(F.col("c.data_type") != F.col("p.data_type"), "type_changed"))
    return (j.select(F.coalesce("c.table_name", "p.table_name").alias("table_name"),
                     F.coalesce("c.column_name", "p.column_name").alias("column_name"),
                     change.alias("change"), F.col("p.data_type").alias("previous_type"),
                     F.col("c.data_type").alias("current_type"))
            .filter(F.col("change").isNotNull()))


# ------------------------------------------------------------- nested paths
#: What a type can become without losing a value: type -> types it fits into directly.
WIDER = {"tinyint": ("smallint",), "smallint": ("int",), "int": ("bigint", "double"), "bigint": (), "float": ("double",),
         "date": ("timestamp_ntz",)}
#: Digits that an integer type needs as a decimal.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def schema_paths(data_type: T.DataType, path: str = "") -> dict[str, str]:
    """Path -> type of everything in a type: struct fields as ``a.b``, array
    elements as ``a[]``, map keys and values as ``a{key}`` and ``a{value}``.
    A struct, array or map has the path of its own and those of its parts."""
    if isinstance(data_type, T.StructType):
        out = {path: "struct"} if path else {}
        for f in data_type.fields:
            out |= schema_paths(f.dataType, f"{path}.{f.name}" if path else f.name)
        return out
    if isinstance(data_type, T.ArrayType):
        return {path: "array"} | schema_paths(data_type.elementType, f"{path}[]")
    if isinstance(data_type, T.MapType):
        return ({path: "map"} | schema_paths(data_type.keyType, f"{path}{{key}}")
                | schema_paths(data_type.valueType, f"{path}{{value}}"))
    return {path: data_type.simpleString()}


def fits_into(a: str, b: str) -> bool:
    """Whether every value of type ``a`` is one of type ``b``."""
    if a == b:
        return True
    if b.startswith("decimal("):
        digits, scale = map(int, b[8:-1].split(","))
        if a.startswith("decimal("):
            p, s = map(int, a[8:-1].split(","))
            return scale >= s and digits - scale >= p - s
        return a in DIGITS and digits - scale >= DIGITS[a]
    return any(fits_into(w, b) for w in WIDER.get(a, ()))


def type_change(previous: str, current: str) -> str:
    """'widened' (no value is lost), 'narrowed' (the other way round) or 'incompatible'."""
    return "widened" if fits_into(previous, current) else "narrowed" if fits_into(current, previous) else "incompatible"


def nested_drift(previous: T.StructType, current: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(path, change, previous type, current type) of every path that differs, with
    change in new, missing, widened, narrowed, incompatible. Of a struct, array
    or map that is new, missing or something else now, only its own path is named."""
    before, now, out = schema_paths(previous), schema_paths(current), []
    for path in sorted(before.keys() | now.keys()):
        a, b = before.get(path), now.get(path)
        inside = any(path != p and path.startswith(p) and path[len(p)] in ".[{" for p, *_ in out)
        if a != b and not inside:
            out.append((path, "new" if a is None else "missing" if b is None else type_change(a, b), a, b))
    return out


def path_values(df: DataFrame, path: str) -> DataFrame:
    """``(value)``: every value at ``path``, one row each, as ``schema_paths`` names it. Elements of NULL or empty parts have no row."""
    value = None
    for name, part in re.findall(r"([^.\[{]+)|(\[\]|\{key\}|\{value\})", path):
        if name:
            value = F.col(f"`{name}`") if value is None else value.getField(name)
        else:
            whole = {"[]": value, "{key}": F.map_keys(value), "{value}": F.map_values(value)}[part]
            df, value = df.select(F.explode(whole).alias("value")), F.col("value")
    return df.select(value.alias("value"))


def values_lost(df: DataFrame, path: str, current_type: str) -> DataFrame:
    """``(n_values, n_lost)``: how many values there are at ``path``, and how many
    don't come back the same from ``current_type``."""
    values = path_values(df, path)
    there = F.col("value").try_cast(current_type)
    back = there.try_cast(values.schema["value"].dataType)
    return values.agg(F.count("value").alias("n_values"),
                      F.count_if(F.col("value").isNotNull() & ~back.eqNullSafe(F.col("value"))).alias("n_lost"))


def check_drift_many(spark: SparkSession, current: dict[str, DataFrame],
                     previous: dict[str, DataFrame | None]) -> DataFrame:
    """Drift over several tables in one result (union of the per-table checks)."""
    out = None
    for name, df in current.items():
        prev = previous.get(name)
        prev_snap = schema_snapshot(spark, prev, name) if prev is not None else None
        d = schema_drift(schema_snapshot(spark, df, name), prev_snap)
        out = d if out is None else out.unionByName(d)
    return out


def save_snapshot(snapshot: DataFrame, path: str) -> None:
    """Store a schema snapshot as JSON (replaced after every check)."""
    snapshot.coalesce(1).write.mode("overwrite").json(path)      # one row per column: tiny by construction


def load_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored snapshot, or None on the first run (no baseline yet)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(SNAPSHOT_SCHEMA).json(path)


def check_and_record(spark: SparkSession, df: DataFrame, table: str, log_dir: str) -> DataFrame:
    """Compare ``df``'s schema with the stored snapshot of ``table`` and replace
    the snapshot; returns the drift rows ('baseline' rows on the first run).
    The result is materialised before the snapshot is overwritten."""
    path = f"{log_dir.rstrip('/')}/{table}_schema"
    current = schema_snapshot(spark, df, table)
    previous = load_snapshot(spark, path)
    drift = schema_drift(current, previous)
    rows = drift.collect()                                         # bounded by the column count
    save_snapshot(current, path)
    return spark.createDataFrame(rows, drift.schema)
