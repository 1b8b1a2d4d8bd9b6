"""Profiling and validation operators.

Constraints are data, not DDL: a registry of NOT NULL / UNIQUE / CHECK /
FOREIGN KEY / DEFAULT rules. All rules of all tables are answered by one
aggregate over one read of each table; when a table is written, its per-row
rules are counted by the write itself (``row_metrics`` as observed metrics).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    allow_null: bool = True          # SQL UNIQUE lets several NULLs through


@dataclass(frozen=True)
class Check:
    name: str
    expr: str                        # SQL boolean; a row violates when it is FALSE (NULL passes)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]


@dataclass(frozen=True)
class Default:
    column: str
    value: object
    type: str


@dataclass
class TableRules:
    table: str
    rules: list = field(default_factory=list)


def row_metrics(rules: TableRules) -> dict[str, Column]:
    """Constraint name -> number of rows that break a NOT NULL or CHECK rule, as
    an aggregate that a write can observe."""
    return {_name(r): F.count_if(_broken(r)) for r in rules.rules if isinstance(r, (NotNull, Check))}


def constraint_violations(tables: dict[str, DataFrame], registry: list[TableRules], row_rules: bool = True) -> DataFrame:
    """Rows (table_name, constraint_name, kind, violations) for every rule.

    Every table is read once, whatever the number of its rules: a row of it gives
    a row (rule, key) for each key that a UNIQUE or FOREIGN KEY rule looks at, on
    either side of the reference, and for each row rule that it breaks. One
    aggregate by rule and key (a frequent key is added up before the shuffle)
    answers all rules. ``row_rules=False`` leaves out NOT NULL and CHECK.
    """
    listed = [(tr.table, r) for tr in registry for r in tr.rules
              if isinstance(r, (Unique, ForeignKey)) or (row_rules and isinstance(r, (NotNull, Check)))]
    spark = next(iter(tables.values())).sparkSession

    def entry(rule: int, key: tuple[Column, Column] | None, n: int, parent: int) -> Column:
        number, words = key or (F.lit(None).cast("long"), F.lit(None).cast("string"))
        return F.struct(F.lit(rule).alias("rule"), number.alias("number"), words.alias("words"),
                        F.lit(n).cast("long").alias("n"), F.lit(parent).alias("parent"))

    parts = []
    for table, df in tables.items():
        types = {f.name: f.dataType for f in df.schema.fields}
        entries, row_entries, any_broken = [], [], F.lit(False)
        for i, (owner, r) in enumerate(listed):
            if owner == table and isinstance(r, (NotNull, Check)):
                row_entries.append(F.when(_broken(r), entry(i, None, 1, 0)))
                any_broken = any_broken | _broken(r)
            elif owner == table and isinstance(r, Unique):
                here = entry(i, _key(r.columns, [types[c] for c in r.columns]), 1, 0)
                entries.append(F.when(_all_set(r.columns), here) if r.allow_null else here)
            elif isinstance(r, ForeignKey):
                if owner == table:              # a NULL reference passes
                    as_parent = {f.name: f.dataType for f in tables[r.ref_table].schema.fields}
                    key = _key(r.columns, [as_parent[c] for c in r.ref_columns])
                    entries.append(F.when(_all_set(r.columns), entry(i, key, 1, 0)))
                if r.ref_table == table:
                    entries.append(F.when(_all_set(r.ref_columns), entry(i, _key(r.ref_columns, [types[c] for c in r.ref_columns]), 0, 1)))
        if entries or row_entries:
            every = F.array(*entries, *row_entries)
            if entries:                         # most rows break no row rule
                every = F.when(any_broken, every).otherwise(F.array(*entries))
            parts.append(df.select(F.explode(every).alias("x")).where("x IS NOT NULL").select("x.*"))
    names = spark.createDataFrame([(i, t, _name(r), _kind(r)) for i, (t, r) in enumerate(listed)],
                                  "rule int, table_name string, constraint_name string, kind string")
    if not parts:
        return names.select("table_name", "constraint_name", "kind", F.lit(0).cast("long").alias("violations"))
    by_key = reduce(DataFrame.unionAll, parts).groupBy("rule", "number", "words").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    unique = [i for i, (_, r) in enumerate(listed) if isinstance(r, Unique)]
    foreign = [i for i, (_, r) in enumerate(listed) if isinstance(r, ForeignKey)]
    fine = (F.col("rule").isin(unique) & (F.col("n") == 1)) | (F.col("rule").isin(foreign) & (F.col("parent") == 1))
    found = by_key.where(~fine).groupBy("rule").agg(F.sum("n").alias("found"))
    return (names.join(found, "rule", "left")
            .select("table_name", "constraint_name", "kind", F.coalesce("found", F.lit(0).cast("long")).alias("violations")))


def _broken(r: NotNull | Check) -> Column:
    return F.col(r.column).isNull() if isinstance(r, NotNull) else ~F.coalesce(F.expr(r.expr), F.lit(True))


def _all_set(columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def _key(columns: tuple[str, ...], types: list[T.DataType]) -> tuple[Column, Column]:
    """The columns' values, in the given types, as one number if they are an
    integer and as one text otherwise."""
    values = [F.col(c).cast(t) for c, t in zip(columns, types)]
    if len(values) == 1 and isinstance(types[0], T.IntegralType):
        return values[0].cast("long"), F.lit(None).cast("string")
    if len(values) == 1:
        return F.lit(None).cast("long"), values[0].cast("string")
    texts = F.struct(*(v.cast("string").alias(f"c{i}") for i, v in enumerate(values)))
    return F.lit(None).cast("long"), F.to_json(texts, {"ignoreNullFields": "false"})


def _name(r) -> str:
    if isinstance(r, NotNull):
        return f"not_null_{r.column}"
    if isinstance(r, Check):
        return r.name
    if isinstance(r, Unique):
        return "unique_" + "_".join(r.columns)
    if isinstance(r, ForeignKey):
        return "fk_" + "_".join(r.columns) + "_" + r.ref_table
    raise TypeError(r)


def _kind(r) -> str:
    return {NotNull: "NOT NULL", Check: "CHECK", Unique: "UNIQUE", ForeignKey: "FOREIGN KEY"}[type(r)]


def foreign_keys(spark: SparkSession, registry: list[TableRules]) -> DataFrame:
    """The foreign keys of the registry as a table (the catalog listing)."""
    rows = [(tr.table, ",".join(r.columns), _name(r), r.ref_table, ",".join(r.ref_columns))
            for tr in registry for r in tr.rules if isinstance(r, ForeignKey)]
    schema = "table_name string, column_name string, constraint_name string, referenced_table string, referenced_column string"
    return spark.createDataFrame(rows, schema)


def apply_defaults(df: DataFrame, rules: list[TableRules] | TableRules) -> DataFrame:
    """Add DEFAULT columns that are *absent* from the input (a present NULL stays NULL)."""
    rules = rules.rules if isinstance(rules, TableRules) else [r for tr in rules for r in tr.rules]
    for r in rules:
        if isinstance(r, Default) and r.column not in df.columns:
            df = df.withColumn(r.column, F.lit(r.value).cast(r.type))
    return df


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows carry ``reason`` = the failed rule
    names, comma-separated. A rule fails when its expression is FALSE."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in checks.items()]))
    tagged = df.withColumn("_failed", failed)
    accepted = tagged.filter(F.size("_failed") == 0).drop("_failed")
    rejected = tagged.filter(F.size("_failed") > 0).withColumn("reason", F.array_join("_failed", ",")).drop("_failed")
    return accepted, rejected


# ------------------------------------------------------------------ profiling
def null_counts(df: DataFrame) -> DataFrame:
    """Long form (column_name, n_null) from one aggregate pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                  for c in df.columns]))
    return one.select(stacked.alias("x")).select("x.*")


def describe_exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column (pandas describe).

    Mean and standard deviation combine partial (n, mean, M2) of the values as
    they are, so no value is rounded and nothing overflows; they are exact up to
    the last digits of a double, which depend on the order of the partials.
    Quartiles come from the distributed exact quantiles (linear interpolation
    like pandas).
    """
    from tillbook.operators.stats import exact_quantiles
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("count"),
                     *(F.col(f"{c}__{k}").alias(k) for k in ("mean", "std", "min", "max"))) for c in columns]
    moments = one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])          # at most 3 rows per column
    quart = q.groupBy("column_name").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                           for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return (moments.join(quart, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``info()``-style column list: name, type, non-null count (one pass)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                                           F.col(c).alias("non_null")) for c in df.columns]))
    return counts.select(stacked.alias("x")).select("x.*")
