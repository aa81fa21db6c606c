"""Scalar functions as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An id, a colon, and a start and end that may be negative or carry an insertion letter.
RANGE = r"^([^:]*):(-?[0-9A-Za-z]+)(?:-(-?[0-9A-Za-z]+))?$"


def parse_range(text: Column) -> Column:
    """``chain:from-to`` as a struct; a single value is both ends, anything else gives ``.``, ``0``, ``0``."""
    ok = text.rlike(RANGE)
    first = F.regexp_extract(text, RANGE, 2)
    last = F.regexp_extract(text, RANGE, 3)
    return F.struct(
        F.when(ok, F.regexp_extract(text, RANGE, 1)).otherwise(".").alias("chain"),
        F.when(ok, first).otherwise("0").alias("start"),
        F.when(ok, F.when(last == "", first).otherwise(last)).otherwise("0").alias("end"),
    )


def p_affinity(value: Column, unit: Column | None = None) -> Column:
    """Negative log10 of a concentration in mol/l: of nanomoles, or by unit; null where it isn't positive or known."""
    scale = F.lit(1e-9)
    if unit is not None:
        scale = (
            F.when(unit == "fM", 1e-15).when(unit == "pM", 1e-12).when(unit == "nM", 1e-9).when(unit == "uM", 1e-6).when(unit == "mM", 1e-3).when(unit == "M", 1.0)
        )
    return F.when(value > 0, -F.log10(value * scale))


def clean_number(text: Column) -> Column:
    """The number in text such as ``>10``; null if there is none."""
    return F.regexp_replace(text, "[<>~=\\s]", "").try_cast("double")


def pad_id(text: Column, width: int = 3) -> Column:
    """Whole numbers padded with zeros to ``width``, of longer ones the last digits; other text as it is."""
    return F.when(text.rlike("^[0-9]+$"), F.right(F.concat(F.lit("0" * (width - 1)), text), F.lit(width))).otherwise(text)


def digits(text: Column) -> Column:
    """The digits of text as a whole number; null without any."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


def half_even_percent(x: Column) -> Column:
    """100 x rounded half to even."""
    return F.bround(x * 100).cast("byte")


def truncated_percent(x: Column) -> Column:
    """100 times x rounded to two places, cut to a whole number; 0.29 gives 28.

    Rounded as binary fractions are, by the nearest of x times 100: 0.575 is 57.49…, hence 0.57.
    """
    return (F.rint(x * 100) / 100 * 100).cast("int")


def best_of(scores: dict[str, Column], *, near: float = 1e-6) -> tuple[Column, Column]:
    """The larger of two scores and where it is from: ``both`` within ``near``, the first on ties."""
    (a_name, a), (b_name, b) = scores.items()
    source = (
        F.when(a.isNull() & b.isNull(), F.lit(None).cast("string"))
        .when(a.isNull(), b_name)
        .when(b.isNull(), a_name)
        .when(F.abs(a - b) < near, "both")
        .when(a >= b, a_name)
        .otherwise(b_name)
    )
    return F.greatest(a, b), source


def distinct_text(column: Column, mark: str = "-") -> Column:
    """Aggregate: the distinct values in order, joined by ``mark``."""
    return F.array_join(F.array_sort(F.collect_set(column)), mark)


def code_order(codes: Column) -> Column:
    """Codes by length, longest first, then letters before digits at the first character, then in order."""

    def key(c: Column) -> Column:
        return F.struct((-F.length(c)).alias("n"), c.rlike("^[0-9]").alias("d"), c.alias("c"))

    return F.transform(F.array_sort(F.transform(codes, key)), lambda k: k["c"])


def any_part(code: Column, parts: Sequence[str], mark: str = "-") -> Column:
    """Whether any part of a dashed code is among ``parts``."""
    return F.arrays_overlap(F.split(code, mark), F.array(*map(F.lit, parts)))


def replace_parts(code: Column, names: dict[str, str], mark: str = "-", keep: str = "PRD_") -> Column:
    """Each part of a dashed code by its synonym; codes that start with ``keep`` as they are."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    parts = F.transform(F.split(code, mark), lambda p: F.coalesce(F.element_at(table, p), p))
    return F.when(code.startswith(keep), code).otherwise(F.array_join(parts, mark))


def rule_class(weight: Column, logp: Column, donors: Column, acceptors: Column) -> tuple[Column, Column]:
    """Whether the rule of three (fragment) and the rule of five hold; a fragment passes both."""
    three = F.coalesce((weight < 300) & (logp < 3) & (donors <= 3) & (acceptors <= 3), F.lit(False))
    five = F.coalesce((weight < 500) & (logp < 5) & (donors <= 5) & (acceptors <= 10), F.lit(False))
    return three, three | five


def first_true(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """The label of the first condition that holds."""
    found = F
    for when, label in cases:
        found = found.when(when, label)
    return found.otherwise(default)


def multiset(values: Column) -> Column:
    """Counts by value of an array, as a map."""
    kinds = F.array_sort(F.array_distinct(values))
    counts = F.transform(kinds, lambda k: F.size(F.filter(values, lambda v: v == k)))
    return F.map_from_arrays(kinds, counts)


def multiset_overlap(a: Column, b: Column) -> Column:
    """Sum of the smaller counts of two maps of counts."""
    both = F.map_zip_with(a, b, lambda k, x, y: F.least(F.coalesce(x, F.lit(0)), F.coalesce(y, F.lit(0))))
    return F.aggregate(F.map_values(both), F.lit(0), lambda s, n: s + n)


def merge_maps(first: Column, second: Column) -> Column:
    """Union of two maps; where both have a key the second counts."""
    return F.map_zip_with(first, second, lambda k, x, y: F.coalesce(y, x))


def total_size(m: Column) -> Column:
    """Sum of the sizes of a map's lists."""
    return F.aggregate(F.transform(F.map_values(m), F.size), F.lit(0), lambda s, n: s + n)


def strict_sum(values: Column) -> Column:
    """Sum of an array, null if any is null."""
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return F.when(~F.exists(values, lambda x: x.isNull()), total)


def max_or(values: Column, missing: float = -1.0) -> Column:
    """Largest of an array, a null counting as ``missing``."""
    return F.array_max(F.transform(values, lambda x: F.coalesce(x, F.lit(missing))))


def residue_labels(residues: Column) -> Column:
    """``chain_number`` of a map from chain to numbers."""
    return F.flatten(F.transform(F.map_entries(residues), lambda e: F.transform(e["value"], lambda n: F.concat_ws("_", e["key"], n.cast("string")))))


def hash_texts(texts: Column) -> Column:
    """md5 of an array of texts whatever their order."""
    return F.md5(F.to_json(F.array_sort(texts)))


def pad_to(values: Column, size: int, fill: float = 0) -> Column:
    """An array padded on the right to ``size``."""
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(F.lit(0), F.lit(size) - F.size(values))))


def one_hot(value: Column, labels: Sequence[str], other: str) -> Column:
    """0/1 array over ``labels``; an unknown value counts as ``other``."""
    known = F.coalesce(F.array_position(F.array(*map(F.lit, labels)), value), F.lit(0))
    at = F.when(known > 0, known).otherwise(labels.index(other) + 1)
    return F.transform(F.sequence(F.lit(1), F.lit(len(labels))), lambda k: F.when(k == at, 1).otherwise(0))


def map_rows(rows: DataFrame, function: Callable[[dict], list[dict]], shape: str) -> DataFrame:
    """Rows of ``shape`` that a function makes of each row, as mappings; for kernels of libraries, in Arrow batches."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    empty = rows.sparkSession.createDataFrame([], shape)
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in empty.schema])

    def run(batches):
        for batch in batches:
            found = [made for row in batch.to_pylist() for made in function(row)]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return rows.mapInArrow(run, empty.schema)


def plugin(name: str) -> Callable:
    """A chemistry or structure kernel, by the library that has it; ImportError with a clear text where that is missing."""
    import importlib

    library, _, path = name.partition(":")
    try:
        found = importlib.import_module(library)
    except ImportError as error:
        raise ImportError(f"{name} needs the optional library {library}, which isn't installed") from error
    for part in path.split("."):
        found = getattr(found, part)
    return found
