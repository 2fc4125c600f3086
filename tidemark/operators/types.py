"""Types of text columns, from all their values.

Types form a lattice: every integer is a double, and everything is text; stamps are apart from numbers. A
column's type is the least one that holds all its values. Each part of the rows has its counts
and its least offender per type, and parts merge by adding and comparing, so Spark infers all columns in
one aggregation, combined on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least type first; a value is of a type if it has the form and a value in Spark.
FORMS = {
    "integer": ("^[+-]?[0-9]{1,18}$", "bigint"),
    "double": (r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$", "double"),
    "stamp": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$", "timestamp_ntz"),
}
TEXT = "text"
CASTS = {name: cast for name, (_, cast) in FORMS.items()} | {TEXT: "string"}


def _is(value: Column, name: str) -> Column:
    form, cast = FORMS[name]
    return value.rlike(form) & value.try_cast(cast).isNotNull()


def infer_types(raw: DataFrame) -> DataFrame:
    """(column, inferred, leaning, rows, nulls, conflicts, offender), one row per text column.

    ``inferred`` is the least type of all values, ``text`` if there is none; ``leaning`` the least
    type of more than half of them, ``conflicts`` the number of values that are not of it, and
    ``offender`` the first of these in code-point order. Empty strings count as NULL; spaces around a
    value don't matter. One pass for all columns.
    """
    columns = [n for n, t in raw.dtypes if t == "string"]
    values = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in columns}
    trimmed = raw.select(*[values[c].alias(f"v{i}") for i, c in enumerate(columns)])
    stats = []
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        stats.append(F.count(v).alias(f"n{i}"))
        for name in FORMS:
            fits = _is(v, name)
            stats.append(F.count_if(fits).alias(f"{name}{i}"))
            stats.append(F.min(F.when(v.isNotNull() & ~F.coalesce(fits, F.lit(False)), v)).alias(f"{name}_not{i}"))
    wide = trimmed.agg(F.count(F.lit(1)).alias("rows"), *stats)

    def least(i: int, enough) -> Column:
        out = F.lit(TEXT)
        for name in reversed(FORMS):
            out = F.when(enough(F.col(f"{name}{i}"), F.col(f"n{i}")), F.lit(name)).otherwise(out)
        return F.when(F.col(f"n{i}") == 0, F.lit(TEXT)).otherwise(out)

    rows = []
    for i, c in enumerate(columns):
        leaning = least(i, lambda k, n: 2 * k > n)
        pick = lambda suffix, default: F.coalesce(
            *[F.when(leaning == name, F.col(f"{name}{suffix}")) for name in FORMS], default
        )
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                least(i, lambda k, n: k == n).alias("inferred"),
                leaning.alias("leaning"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                (F.col(f"n{i}") - pick(str(i), F.col(f"n{i}"))).alias("conflicts"),
                F.when(leaning != TEXT, pick(f"_not{i}", F.lit(None).cast("string"))).alias("offender"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def conform(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns under the types of :func:`infer_types`; others stay."""
    made = []
    for name in raw.columns:
        value = F.col(f"`{name}`")
        cast = CASTS[types[name]] if name in types else None
        made.append(value if cast in (None, "string") else F.nullif(F.trim(value), F.lit("")).cast(cast).alias(name))
    return raw.select(*made)
