"""The filter language: triples (column, operator, value), flat for AND, a list of lists for OR of ANDs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Triple = tuple[str, str, Any]
COMPARE = {"=": eq, "==": eq, "!=": ne, "<>": ne, "<": lt, "<=": le, ">": gt, ">=": ge}
OPERATORS = (*COMPARE, "in", "not in", "like")
#: Literal sets beyond this size are joined, not inlined.
INLINE_SET = 1000


def literal(value: Any, kind: T.DataType | None) -> Column:
    """A literal of the column's type, so that text stands for a number where the column is one."""
    return F.lit(value) if kind is None else F.lit(value).cast(kind)


def predicate(triple: Triple, schema: T.StructType | None = None) -> Column:
    """The condition of one triple. An unknown column or operator, or other than three items, is a ValueError."""
    if not isinstance(triple, (tuple, list)) or len(triple) != 3:
        raise ValueError(f"a filter has a column, an operator and a value: {triple!r}")
    name, operator, value = triple
    operator = str(operator).strip().lower()
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator {operator!r}; use one of {', '.join(OPERATORS)}")
    kind = None
    if schema is not None:
        if name not in schema.names:
            raise ValueError(f"unknown column {name!r}; use one of {', '.join(schema.names)}")
        kind = schema[name].dataType
    column = F.col(f"`{name}`")
    if operator in ("in", "not in"):
        values = [value] if isinstance(value, str) or not isinstance(value, Iterable) else list(value)
        if not values:
            return F.lit(operator == "not in")
        found = column.isin([literal(v, kind) for v in values])
        return found if operator == "in" else ~found
    if operator == "like":
        return column.like(str(value))
    return COMPARE[operator](column, literal(value, kind))


def condition(filters: Sequence | None, schema: T.StructType | None = None) -> Column | None:
    """The condition of a filter list: triples are joined by AND; lists of triples by OR. Mixing both is a ValueError."""
    if not filters:
        return None
    nested = [isinstance(f, list) for f in filters]
    if any(nested) != all(nested):
        raise ValueError("filters are triples, or lists of triples, not both")
    groups = list(filters) if all(nested) else [list(filters)]
    return reduce(or_, [reduce(and_, [predicate(t, schema) for t in g]) for g in groups if g])


def projection(columns: Sequence[str] | None, schema: T.StructType | None, extra: Sequence[str] = ()) -> list[str]:
    """Columns to read: all of the schema where none are named. A column that the schema lacks is a ValueError."""
    if not columns or list(columns) == ["*"]:
        return ["*"] if schema is None else [*schema.names, *extra]
    if schema is not None and (unknown := [c for c in columns if c not in schema.names and c not in extra and c != "filename"]):
        raise ValueError(f"unknown columns {unknown}; use some of {schema.names}")
    return list(dict.fromkeys(columns))


def select_where(
    df: DataFrame,
    *,
    columns: Sequence[str] | None = None,
    filters: Sequence | None = None,
    schema: T.StructType | None = None,
    need_filters: bool = False,
    denied: Sequence[str] = (),
) -> DataFrame:
    """Filter and project; Catalyst pushes both to the scan. With ``need_filters`` an empty filter list is a ValueError."""
    if need_filters and not filters:
        raise ValueError("this table is read with filters only")
    names = {t[0] for f in filters or [] for t in (f if isinstance(f, list) else [f]) if len(t) == 3}
    if refused := sorted((set(columns or ()) | names) & set(denied)):
        raise ValueError(f"these columns can't be queried: {refused}")
    where = condition(filters, schema)
    if where is not None:
        df = df.where(where)
    return df.select(*projection(columns, schema))


def members(df: DataFrame, column: str, values: Iterable, *, negate: bool = False) -> DataFrame:
    """Rows whose column is (not) among ``values``. A large set is joined as a table, which the plan may broadcast."""
    values = list(dict.fromkeys(values))
    if len(values) <= INLINE_SET:
        found = F.col(column).isin(values) if values else F.lit(False)
        return df.where(~found if negate else found)
    spark: SparkSession = df.sparkSession
    table = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(column, df.schema[column].dataType)]))
    return df.join(table, column, "left_anti" if negate else "left_semi")


def all_of(conditions: Sequence[Column]) -> Column:
    """AND of conditions, a null one counting as false."""
    return reduce(and_, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(True))


def in_ranges(ranges: dict[str, tuple[float, float]]) -> Column:
    """Whether each column lies in its inclusive range; null is outside."""
    return all_of([F.col(c).between(*r) for c, r in ranges.items()])
