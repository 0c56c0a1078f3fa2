"""Dataset query: metrics x dimensions x filters over one DataFrame, as a plan of built-in operators."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from parcelmill.functions.times import between, time_bucket

TIME_LABEL = "__timestamp"


class QueryError(ValueError):
    """The query object cannot be planned."""


@dataclass(frozen=True)
class Agg:
    """Simple aggregate of a column."""

    function: str
    column: str
    label: str | None = None


@dataclass(frozen=True)
class Expr:
    """SQL expression under a label: an aggregate when used as a metric, a value when used as a column."""

    sql: str
    label: str


@dataclass(frozen=True)
class Filter:
    column: str | Expr
    op: str
    value: object = None
    grain: str | None = None


Metric = str | Agg | Expr
Dimension = str | Expr

AGGREGATES: dict[str, Callable[[str], Column]] = {
    "COUNT": F.count,
    "COUNT_DISTINCT": F.count_distinct,
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
}


# The parameters of a query object, by which clients name them.
@dataclass
class DatasetQuery:
    metrics: list[Metric] | None = None
    groupby: list[Dimension] = field(default_factory=list)
    columns: list[Dimension] = field(default_factory=list)
    filters: list[Filter] = field(default_factory=list)
    granularity: str | None = None
    time_grain: str | None = None
    is_timeseries: bool = False
    from_dttm: str | None = None
    to_dttm: str | None = None
    time_shift: str | None = None
    where: str | None = None
    having: str | None = None
    orderby: list[tuple[Metric, bool]] = field(default_factory=list)
    order_desc: bool = True
    row_limit: int | None = None
    row_offset: int | None = None
    series_columns: list[str] = field(default_factory=list)
    series_limit: int | None = None
    series_limit_metric: Metric | None = None
    is_rowcount: bool = False


@dataclass
class Dataset:
    """Rows, saved metrics by name, main time column, and the row-level predicate that always holds."""

    rows: DataFrame
    metrics: dict[str, Callable[[], Column]] = field(default_factory=dict)
    time_column: str | None = None
    row_level: Column | None = None
    fetch_predicate: str | None = None


# -- metrics and dimensions ------------------------------------------------------------------------


def metric_label(metric: Metric) -> str:
    if isinstance(metric, Agg):
        return metric.label or f"{metric.function}({metric.column})"
    return metric.label if isinstance(metric, Expr) else metric


def metric_column(ds: Dataset, metric: Metric) -> Column:
    if isinstance(metric, Agg):
        if metric.function not in AGGREGATES:
            raise QueryError(f"unknown aggregate {metric.function!r}")
        _require_column(ds, metric.column)
        return AGGREGATES[metric.function](metric.column)
    if isinstance(metric, Expr):
        return F.expr(metric.sql)
    if metric not in ds.metrics:
        raise QueryError(f"no saved metric is called {metric!r}")
    return ds.metrics[metric]()


def _require_column(ds: Dataset, name: str) -> None:
    if name not in ds.rows.columns:
        raise QueryError(f"the dataset has no column {name!r}")


def dimension_label(dim: Dimension) -> str:
    return dim.label if isinstance(dim, Expr) else dim


def _dimension(ds: Dataset, query: DatasetQuery, dim: Dimension, time_column: str | None) -> Column:
    if isinstance(dim, Expr):
        return F.expr(dim.sql)
    if dim in ds.rows.columns:
        if dim == time_column and query.time_grain:
            return time_bucket(F.col(dim), query.time_grain)
        return F.col(dim)
    # anything else is an expression that serves as its own label
    return F.expr(f"({dim})")


# -- filters ---------------------------------------------------------------------------------------

COMPARISONS: dict[str, Callable[[Column, object], Column]] = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def _membership(column: Column, values: list, negate: bool) -> Column:
    if not values:
        raise QueryError("IN and NOT IN need at least one value")
    listed = [v for v in values if v is not None]
    cond = column.isin(listed) if listed else F.lit(False)
    if len(listed) < len(values):
        cond = column.isNull() | cond
    return ~cond if negate else cond


def shifted(bound: str | None, shift: str | None) -> Column | None:
    """Time bound moved back by an interval such as ``1 year``."""
    if bound is None:
        return None
    at = F.lit(bound).cast("timestamp_ntz")
    if shift is None:
        return at
    if not re.fullmatch(r"\d+ (second|minute|hour|day|week|month|year)s?", shift):
        raise QueryError(f"invalid time shift {shift!r}")
    return at - F.expr(f"interval {shift}")


def filter_condition(ds: Dataset, flt: Filter, time_shift: str | None = None) -> Column | None:
    """Predicate of one filter; a filter on an unknown column has no effect."""
    if isinstance(flt.column, Expr):
        column, dtype = F.expr(flt.column.sql), None
    elif flt.column in ds.rows.columns:
        column, dtype = F.col(flt.column), ds.rows.schema[flt.column].dataType
    else:
        return None
    op = flt.op.upper()
    if op == "TEMPORAL_RANGE":
        if not isinstance(flt.value, str) or flt.value.count(" : ") != 1:
            raise QueryError("a time range is written 'start : end'")
        start, end = (side.strip() or None for side in flt.value.split(" : "))
        at = time_bucket(column, flt.grain) if flt.grain else column
        return between(at, shifted(start, time_shift), shifted(end, time_shift))
    if flt.grain:
        column = time_bucket(column, flt.grain)
    if op in ("IN", "NOT IN"):
        return _membership(column, list(flt.value or []), op == "NOT IN")
    if op == "IS NULL":
        return column.isNull()
    if op == "IS NOT NULL":
        return column.isNotNull()
    if op in ("IS TRUE", "IS FALSE"):
        truth = column if isinstance(dtype, BooleanType) else column.cast("boolean")
        return truth.eqNullSafe(op == "IS TRUE")
    if op in COMPARISONS:
        if flt.value is None:
            if op == "==":
                return column.isNull()
            if op == "!=":
                return column.isNotNull()
            raise QueryError(f"{op} needs a value to compare with")
        return COMPARISONS[op](column, flt.value)
    if op in ("LIKE", "ILIKE"):
        if flt.value is None:
            raise QueryError(f"{op} needs a value to compare with")
        text = column if isinstance(dtype, StringType) else column.cast("string")
        return text.like(flt.value) if op == "LIKE" else text.ilike(flt.value)
    raise QueryError(f"unknown filter operator {flt.op!r}")


# -- the query -------------------------------------------------------------------------------------


def run(ds: Dataset, query: DatasetQuery) -> DataFrame:
    """Plan the query. Result columns carry the requested labels, in the requested order."""
    q = query
    grouped = q.metrics is not None or bool(q.groupby)
    if not (q.metrics or q.groupby or q.columns):
        raise QueryError("a query needs metrics, groups or columns")
    time_column = q.granularity or ds.time_column
    if q.is_timeseries and time_column is None:
        raise QueryError("a time series needs a time column")
    if q.granularity is not None:
        _require_column(ds, q.granularity)

    metrics = {metric_label(m): metric_column(ds, m) for m in q.metrics or []}
    rows = _filtered(ds, q, time_column)

    chosen = (q.groupby or q.columns) if grouped else q.columns
    dims = {dimension_label(d): _dimension(ds, q, d, time_column) for d in chosen}
    series = {
        k: c for k, c in dims.items() if (q.is_timeseries and not q.series_columns) or k in q.series_columns
    }
    if q.is_timeseries:
        at = F.col(time_column)
        dims = {TIME_LABEL: time_bucket(at, q.time_grain) if q.time_grain else at} | dims

    if not grouped:
        order = [(_raw_order(ds, m), asc) for m, asc in q.orderby]
        result = _ordered(rows, order).select(*[c.alias(k) for k, c in dims.items()])
        return _rowcount(_page(result, q), q)

    if q.series_limit and series:
        rows = _keep_top_series(ds, q, rows, series, metrics)
    labels = [*dims, *[m for m in metrics if m not in dims]]
    visible = {k: c for k, c in metrics.items() if k not in dims}
    hidden, order = _grouped_order(ds, q, dims, metrics)
    values = [c.alias(k) for k, c in {**visible, **hidden}.items()]
    keyed = rows.groupBy(*[c.alias(k) for k, c in dims.items()])
    if q.having:
        values.append(F.expr(f"({q.having})").alias("_having"))
    result = keyed.agg(*values) if values else keyed.agg(F.lit(1).alias("_one"))
    if q.having:
        result = result.filter("_having")
    result = _page(_ordered(result, [(F.col(f"`{k}`"), asc) for k, asc in order]), q)
    return _rowcount(result.select(*[F.col(f"`{k}`") for k in labels]), q)


def _filtered(ds: Dataset, q: DatasetQuery, time_column: str | None) -> DataFrame:
    parts = []
    if time_column is not None:
        parts.append(between(F.col(time_column), shifted(q.from_dttm, q.time_shift), shifted(q.to_dttm, q.time_shift)))
    parts += [c for f in q.filters if (c := filter_condition(ds, f, q.time_shift)) is not None]
    if ds.row_level is not None:
        parts.append(ds.row_level)
    if q.where:
        parts.append(F.expr(f"({q.where})"))
    return ds.rows.filter(reduce(lambda a, b: a & b, parts)) if parts else ds.rows


def _raw_order(ds: Dataset, item: Metric) -> Column:
    if isinstance(item, str):
        _require_column(ds, item)
        return F.col(item)
    if isinstance(item, Expr):
        return F.expr(item.sql)
    raise QueryError("an aggregate cannot order raw rows")


def _grouped_order(ds: Dataset, q: DatasetQuery, dims: dict, metrics: dict):
    """Order labels, and the aggregates that are computed only to order by them."""
    hidden, order = {}, []
    for item, ascending in q.orderby:
        label = metric_label(item)
        if label in dims or label in metrics:
            order.append((label, ascending))
            continue
        if isinstance(item, str) and item not in ds.metrics:
            raise QueryError(f"cannot order by {item!r}: it is no label and no saved metric")
        hidden[f"_order_{label}"] = metric_column(ds, item)
        order.append((f"_order_{label}", ascending))
    return hidden, order


def _ordered(df: DataFrame, order: list[tuple[Column, bool]]) -> DataFrame:
    return df.orderBy(*[c.asc() if asc else c.desc() for c, asc in order]) if order else df


def _page(df: DataFrame, q: DatasetQuery) -> DataFrame:
    if q.row_offset:
        df = df.offset(q.row_offset)
    return df.limit(q.row_limit) if q.row_limit else df


def _rowcount(df: DataFrame, q: DatasetQuery) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rowcount")) if q.is_rowcount else df


def _keep_top_series(ds: Dataset, q: DatasetQuery, rows: DataFrame, series: dict, metrics: dict) -> DataFrame:
    """Rows of the best ``series_limit`` groups. A group with a NULL key never matches.

    The ranked list is a top-k of an aggregate, so it has at most ``series_limit`` rows; whether it is
    broadcast is left to its size at run time. Ties are broken by the group key.
    """
    if q.series_limit_metric is not None:
        by = metric_column(ds, q.series_limit_metric)
    else:
        by = next(iter(metrics.values()), F.count(F.lit(1)))
    names = {k: f"_series_{i}" for i, k in enumerate(series)}
    ranked = rows.groupBy(*[series[k].alias(n) for k, n in names.items()]).agg(by.alias("_by"))
    rank = F.col("_by").desc() if q.order_desc else F.col("_by").asc()
    best = ranked.orderBy(rank, *names.values()).limit(q.series_limit).select(*names.values())
    on = reduce(lambda a, b: a & b, [series[k] == F.col(n) for k, n in names.items()])
    return rows.join(best, on, "left_semi")


def distinct_values(ds: Dataset, column: str, limit: int | None = None) -> DataFrame:
    """Values for a filter picker: all of them, or the first ``limit`` in their order."""
    _require_column(ds, column)
    rows = ds.rows.filter(F.expr(ds.fetch_predicate)) if ds.fetch_predicate else ds.rows
    if ds.row_level is not None:
        rows = rows.filter(ds.row_level)
    values = rows.select(column).distinct()
    return values.orderBy(column).limit(limit) if limit else values


def virtual_dataset(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None, **dataset) -> Dataset:
    """Dataset over one SELECT (a CTE included), which may name the given views.

    Spark parses the text as a query in a FROM clause, so anything but one read-only statement is a
    syntax error there.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise QueryError("a virtual dataset needs a SELECT")
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    return Dataset(spark.sql(f"SELECT * FROM (\n{text}\n) AS selected"), **dataset)
