"""Declarative data-quality checks.

Each check yields its failing rows as a DataFrame (to inspect or store) and
a failure count for the summary.  Counts follow the usual data-test
conventions: ``unique`` and ``accepted_values`` count offending *values*
(NULL never offends), ``not_null``, ``relationships`` and ``max_length``
count offending *rows*.

All checks of all models are counted together: every model is scanned once, and a row
yields one tagged entry per check that looks at a key (its value) or that it
fails (no value).  One grouped pass over (tag, value) counts the entries by role, so uniqueness,
accepted values and orphans of a key come from the same groups; a second, global
aggregate turns them into one count per check.  Entries are summed before they are
shuffled: a value that a third of all rows share leaves a task as one row.

A model whose rows were counted while it was written (``session.materialize_counted``,
tables in versions) is not scanned to compare row counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted_values | relationships | max_length
    #            | value_range | row_count_equal | forbidden_columns
    model: str
    column: str | None = None
    params: Mapping = field(default_factory=dict)
    name: str | None = None

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        parts = [self.kind, self.model] + ([self.column] if self.column else [])
        return "__".join(parts)


def unique(model, column):
    return Check("unique", model, column)


def not_null(model, column):
    return Check("not_null", model, column)


def accepted_values(model, column, values):
    """``values``: a list of literals or the name of a model holding them."""
    return Check("accepted_values", model, column, {"values": values})


def relationships(model, column, to_model, to_column):
    return Check("relationships", model, column, {"to": to_model, "field": to_column})


def max_length(model, column, n):
    return Check("max_length", model, column, {"n": n})


def value_range(model, column, lo=None, hi=None):
    return Check("value_range", model, column, {"lo": lo, "hi": hi})


def row_count_equal(model, other):
    return Check("row_count_equal", model, None, {"other": other})


def forbidden_columns(model, columns):
    return Check("forbidden_columns", model, None, {"columns": list(columns)})


def primary_key(model, column):
    return [unique(model, column), not_null(model, column)]


def decimal_bounds(dtype: T.DecimalType) -> Decimal:
    """Largest magnitude a NUMERIC(p, s) column can hold."""
    return Decimal(10) ** (dtype.precision - dtype.scale) - Decimal(1).scaleb(-dtype.scale)


# ---------------------------------------------------------------- failing rows

def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, Decimal):
        return f"{value}BD"
    return repr(value)


def _row_predicate_sql(check: Check) -> str | None:
    """SQL text of the per-row failure predicate of a row-local check."""
    if check.column is None:
        return None
    c = _ident(check.column)
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "max_length":
        return f"char_length(CAST({c} AS STRING)) > {int(check.params['n'])}"
    if check.kind == "value_range":
        lo, hi = check.params.get("lo"), check.params.get("hi")
        conds = []
        if lo is not None:
            conds.append(f"{c} < {_literal(lo)}")
        if hi is not None:
            conds.append(f"{c} > {_literal(hi)}")
        return f"{c} IS NOT NULL AND ({' OR '.join(conds) or 'false'})"
    return None


def _row_predicate(check: Check) -> F.Column | None:
    sql = _row_predicate_sql(check)
    return None if sql is None else F.expr(sql)


def failing_rows(check: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    df = models[check.model]
    pred = _row_predicate(check)
    if pred is not None:
        return df.where(pred)
    c = check.column
    if check.kind == "unique":
        return (
            df.where(F.col(c).isNotNull())
            .groupBy(c)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1)
        )
    if check.kind == "accepted_values":
        values = df.where(F.col(c).isNotNull()).groupBy(c).agg(
            F.count(F.lit(1)).alias("n_records")
        )
        spec = check.params["values"]
        if not isinstance(spec, str):
            return values.where(~F.col(c).isin(list(spec)))
        allowed = models[spec]
        allowed = allowed.select(F.col(allowed.columns[0]).alias("_ok")).distinct()
        return values.join(allowed, F.col(c) == F.col("_ok"), "left_anti")
    if check.kind == "relationships":
        parent = models[check.params["to"]].select(
            F.col(check.params["field"]).alias("_parent_key")
        )
        return df.where(F.col(c).isNotNull()).join(
            parent, F.col(c) == F.col("_parent_key"), "left_anti"
        )
    if check.kind == "row_count_equal":
        other = models[check.params["other"]]
        a = df.agg(F.count(F.lit(1)).alias("_n")).withColumn("_side", F.lit(0))
        b = other.agg(F.count(F.lit(1)).alias("_n")).withColumn("_side", F.lit(1))
        both = a.unionByName(b).agg(
            F.sum(F.when(F.col("_side") == 0, F.col("_n"))).alias("n_model"),
            F.sum(F.when(F.col("_side") == 1, F.col("_n"))).alias("n_other"),
        )
        return both.where(F.col("n_model") != F.col("n_other"))
    if check.kind == "forbidden_columns":
        present = [x for x in check.params["columns"] if x in df.columns]
        spark = df.sparkSession
        return spark.createDataFrame([(x,) for x in present], "column_name string")
    raise ValueError(f"unknown check kind {check.kind}")


# --------------------------------------------------------------------- summary

_SUMMARY_SCHEMA = "test_name string, kind string, model string, column_name string, failures long"


def _summary_sql(check: Check, failures_sql: str) -> str:
    """SQL struct of one summary row (built as text: one parse, not many calls)."""
    return (
        "named_struct("
        f"'test_name', {_literal(check.test_name)}, "
        f"'kind', {_literal(check.kind)}, "
        f"'model', {_literal(check.model)}, "
        f"'column_name', CAST({_literal(check.column)} AS STRING), "
        f"'failures', CAST({failures_sql} AS BIGINT))"
    )


def _canonical(c: F.Column, dtype: T.DataType) -> tuple[F.Column, F.Column]:
    """A value of ``dtype`` as (long, string): equal values agree in both."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long"), F.lit(None).cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = c.cast("double") + F.lit(0.0)  # -0.0 equals 0.0
    return F.lit(None).cast("long"), c.cast("string")


class _Entries:
    """The entries that each model's rows yield, and how each check reads the groups."""

    def __init__(self, models: Mapping[str, DataFrame]):
        self.models, self.tags, self.entries, self.roles = models, {}, {}, 0
        self.known: dict[tuple[int, int], int] = {}
        self.asked: dict[int, list] = {}

    def tag(self, *what) -> int:
        return self.tags.setdefault(what, len(self.tags))

    def add(self, model: str, tag: int, role: int, when: F.Column, value: F.Column | None = None, dtype=None) -> None:
        long, text = (F.lit(None).cast("long"), F.lit(None).cast("string")) if value is None else _canonical(value, dtype)
        entry = F.when(when, F.struct(F.lit(tag).alias("tag"), F.lit(role).alias("role"), long.alias("l"), text.alias("s")))
        held = self.entries.setdefault(model, {})
        held[(tag, role)] = entry
        self.roles = max(self.roles, role + 1)

    def key(self, model: str, column: str, tag: int, role: int, dtype: T.DataType | None = None) -> None:
        """Every value of a column but NULL."""
        c = F.col(_ident(column))
        own = self.models[model].schema[column].dataType
        if dtype is not None and own != dtype:
            c, own = c.cast(dtype), dtype
        self.add(model, tag, role, c.isNotNull(), c, own)

    def counted(self, model: str, tag: int, role: int) -> None:
        """All rows of a model: a count known from its write, or one entry a row."""
        n = getattr(self.models[model], "counted_rows", None)
        if n is None:
            self.add(model, tag, role, F.lit(True))
        else:
            self.known[(tag, role)] = n

    def asks(self, tag: int, model: str, column: str) -> int:
        """The role, from 1 on, of a column that is compared with a tag's values."""
        held = self.asked.setdefault(tag, [])
        if (model, column) not in held:
            held.append((model, column))
        return 1 + held.index((model, column))

    def frame(self) -> DataFrame | None:
        parts = [
            self.models[model].select(F.explode(F.array_compact(F.array(*held.values()))).alias("e")).select("e.*")
            for model, held in self.entries.items()
        ]
        return union_all(parts) if parts else None


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that two key columns are compared in."""
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if a == b or (type(a) in whole and type(b) in whole):
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, scale + max(a.precision - a.scale, b.precision - b.scale)), scale)
    if isinstance(a, T.DecimalType) and type(b) in whole or isinstance(b, T.DecimalType) and type(a) in whole:
        d = a if isinstance(a, T.DecimalType) else b
        return T.DecimalType(min(38, d.scale + max(19, d.precision - d.scale)), d.scale)
    numbers = (T.DecimalType, T.FloatType, T.DoubleType, *whole)
    return T.DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else T.StringType()


def run_checks(checks: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """One summary row per check: (test_name, kind, model, column_name, failures)."""
    if not checks:
        raise ValueError("no checks given")
    entries = _Entries(models)
    # how each check reads the groups: SQL over tag, n0, n1, ... summed over all of them
    counts: list[str] = []
    for chk in checks:
        pred, c = _row_predicate_sql(chk), chk.column
        if pred is not None:
            tag = entries.tag("row", chk.model, pred)
            entries.add(chk.model, tag, 0, F.coalesce(F.expr(pred), F.lit(False)))
            counts.append(f"sum(CASE WHEN tag = {tag} THEN n0 END)")
        elif chk.kind == "unique":
            tag = entries.tag("key", chk.model, c)
            entries.key(chk.model, c, tag, 0)
            counts.append(f"count_if(tag = {tag} AND n0 > 1)")
        elif chk.kind == "accepted_values" and not isinstance(chk.params["values"], str):
            tag = entries.tag("key", chk.model, c)
            entries.key(chk.model, c, tag, 0)
            dtype = models[chk.model].schema[c].dataType
            long, text = _canonical(F.col("v"), dtype)
            allowed = models[chk.model].sparkSession.createDataFrame([(v,) for v in chk.params["values"] if v is not None], T.StructType(
                [T.StructField("v", dtype)])).select(long.alias("l"), text.alias("s")).collect()
            is_long = [str(r["l"]) for r in allowed if r["l"] is not None]
            is_text = [_literal(r["s"]) for r in allowed if r["s"] is not None]
            fits = " OR ".join([f"l IN ({', '.join(is_long)})"] * bool(is_long) + [f"s IN ({', '.join(is_text)})"] * bool(is_text)) or "false"
            counts.append(f"count_if(tag = {tag} AND n0 > 0 AND NOT coalesce({fits}, false))")
        elif chk.kind in ("accepted_values", "relationships"):
            # both compare a column with another one's values: role 0 holds them, role 1 asks
            if chk.kind == "relationships":
                other, field_ = chk.params["to"], chk.params["field"]
            else:
                other = chk.params["values"]
                field_ = models[other].columns[0]
            dtype = _wider(models[other].schema[field_].dataType, models[chk.model].schema[c].dataType)
            same = dtype == models[other].schema[field_].dataType
            tag = entries.tag("key", other, field_) if same else entries.tag("key", other, field_, dtype.simpleString())
            entries.key(other, field_, tag, 0, dtype)
            role = entries.asks(tag, chk.model, c)
            entries.key(chk.model, c, tag, role, dtype)
            what = f"n{role}" if chk.kind == "relationships" else f"CAST(n{role} > 0 AS BIGINT)"
            counts.append(f"sum(CASE WHEN tag = {tag} AND n0 = 0 THEN {what} END)")
        elif chk.kind == "row_count_equal":
            tag = entries.tag("rows", chk.model, chk.params["other"])
            for role, model in enumerate((chk.model, chk.params["other"])):
                entries.counted(model, tag, role)
            given = [f"{entries.known[(tag, role)]}" if (tag, role) in entries.known else
                     f"coalesce(sum(CASE WHEN tag = {tag} THEN n{role} END), 0)" for role in (0, 1)]
            counts.append(f"CAST({given[0]} <> {given[1]} AS BIGINT)")
        elif chk.kind == "forbidden_columns":
            counts.append(str(sum(x in models[chk.model].columns for x in chk.params["columns"])))
        else:
            raise ValueError(f"unknown check kind {chk.kind}")
    frame = entries.frame()
    if frame is None:
        spark = models[checks[0].model].sparkSession
        frame = spark.createDataFrame([], "tag int, role int, l long, s string")
    grouped = frame.groupBy("tag", "l", "s").agg(
        *[F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(max(2, entries.roles))])
    totals = grouped.agg(*[F.expr(f"coalesce({sql}, 0)").alias(f"_f{i}") for i, sql in enumerate(counts)])
    rows = ", ".join(_summary_sql(chk, f"_f{i}") for i, chk in enumerate(checks))
    return totals.selectExpr(f"inline(array({rows}))")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of same-schema DataFrames as a balanced tree.

    A left-deep chain re-analyses the growing plan at every step (quadratic
    in the number of parts); a balanced tree keeps plan building cheap.
    """
    parts = list(parts)
    while len(parts) > 1:
        paired = [a.union(b) for a, b in zip(parts[0::2], parts[1::2])]
        if len(parts) % 2:
            paired.append(parts[-1])
        parts = paired
    return parts[0]


def assert_passing(summary: DataFrame) -> None:
    """Raise if any check failed (small collect: one row per check)."""
    failed = summary.where(F.col("failures") > 0).collect()
    if failed:
        detail = ", ".join(f"{r.test_name}={r.failures}" for r in failed)
        raise AssertionError(f"data quality checks failed: {detail}")


def schema_checks(model: str, schema: T.StructType) -> list[Check]:
    """Checks implied by a declared table schema: NOT NULL, lengths, numeric range."""
    out = []
    for f in schema.fields:
        if not f.nullable:
            out.append(not_null(model, f.name))
        if "max_length" in f.metadata:
            out.append(max_length(model, f.name, f.metadata["max_length"]))
        if isinstance(f.dataType, T.DecimalType):
            bound = decimal_bounds(f.dataType)
            out.append(value_range(model, f.name, -bound, bound))
    return out


def pii_leaks(df: DataFrame, source_schema: T.StructType, allowed: Sequence[str] = ()) -> list[str]:
    """Columns of ``df`` that carry a PII tag in ``source_schema``, minus ``allowed``."""
    tagged = {f.name for f in source_schema.fields if f.metadata.get("pii")}
    return [c for c in df.columns if c in tagged and c not in set(allowed)]
