"""Column-shaping operators: typed mapping, schema conformance, stamps, keys, header names."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import RunTime, TIMESTAMP_PATTERNS, as_datetime, as_timestamp, epoch_ms


def quoted(name: str) -> Column:
    """Column by its literal name, which may hold blanks, dots or arrows."""
    return F.col("`" + name.replace("`", "``") + "`")


def read_ddl(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


# The text forms Spark's casts accept, per target type; forms it may still refuse are let through.
_EDGE = r"[\s\p{Cntrl}]*"
_WHOLE = f"^{_EDGE}[+-]?\\d+{_EDGE}$"
_REAL = r"^[0-9+\-.eEdDfF\s\p{Cntrl}]+$|(?i:inf|nan|0x)"
TEXT_FORMS = {
    "tinyint": _WHOLE, "smallint": _WHOLE, "int": _WHOLE, "bigint": _WHOLE,
    "float": _REAL, "double": _REAL,
    "boolean": f"^{_EDGE}(?i:t|true|y|yes|1|f|false|n|no|0){_EDGE}$",
}


def lenient(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast in which a value that does not fit the target type becomes NULL.

    Text is looked at first: a try_cast that fails throws inside, at the price of some fifty good casts, and
    whole columns of bad values do arrive.
    """
    form = TEXT_FORMS.get(target.simpleString()) if isinstance(source, T.StringType) else None
    return col.try_cast(target) if form is None else F.when(col.rlike(form), col.try_cast(target))


def fitted(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """:func:`lenient` that walks into structs, arrays and maps, whatever the depth.

    Struct fields are found by name in any order and case: a missing one is a typed NULL, others are dropped, and a NULL
    struct stays NULL. Array elements and map values are fitted one by one. A map key that does not fit is dropped with
    its value; of keys that become equal the first stays. Text in place of a nested value is read as JSON.
    """
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {field.name.lower(): field for field in source.fields}
        inner = []
        for field in target.fields:
            found = have.get(field.name.lower())
            value = F.lit(None).cast(field.dataType) if found is None else fitted(
                col.getField(found.name), found.dataType, field.dataType)
            inner.append(value.alias(field.name))
        return F.when(col.isNotNull(), F.struct(*inner))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(col, lambda x: fitted(x, source.elementType, target.elementType))
    if isinstance(target, T.MapType) and isinstance(source, T.MapType):
        fit = lambda v: fitted(v, source.valueType, target.valueType)
        if source.keyType == target.keyType:
            return F.transform_values(col, lambda k, v: fit(v))
        entries = F.transform(F.map_entries(col), lambda e: F.struct(
            fitted(e["key"], source.keyType, target.keyType).alias("key"), fit(e["value"]).alias("value")))
        keys = F.transform(entries, lambda e: e["key"])
        first = lambda e, i: e["key"].isNotNull() & (F.array_position(keys, e["key"]) == i + 1)
        return F.map_from_entries(F.filter(entries, first))
    if isinstance(target, (T.StructType, T.ArrayType, T.MapType)) and isinstance(source, T.StringType):
        return F.from_json(col, target)
    return lenient(col, source, target)


def long_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a long, for keys that some feeds hold as text."""
    return lenient(quoted(name), df.schema[name].dataType, T.LongType())


def apply_mapping(df: DataFrame, target: str | T.StructType, sources: Mapping[str, str] | None = None) -> DataFrame:
    """Project to the ``target`` columns in their order, cast, rename; other columns are dropped.

    ``sources`` names the source column of each target column whose name differs. Values that do not fit the
    target type become NULL.
    """
    names = sources or {}
    picked = [(names.get(f.name, f.name), f) for f in read_ddl(target).fields]
    return df.select(*[
        fitted(quoted(name), df.schema[name].dataType, f.dataType).alias(f.name) for name, f in picked
    ])


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Give ``df`` exactly the declared columns: order, type, and typed NULLs where a column is missing.

    Nested columns are conformed field by field, see :func:`fitted`.
    """
    have = {name.lower(): name for name in df.columns}
    picked = []
    for field in read_ddl(schema).fields:
        name = have.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = fitted(quoted(name), df.schema[name].dataType, field.dataType)
        picked.append(value.alias(field.name))
    return df.select(*picked)


def with_nulls(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Append typed NULL columns for those of ``schema`` that ``df`` lacks; keep the rest as it is."""
    have = {name.lower() for name in df.columns}
    missing = [f for f in read_ddl(schema).fields if f.name.lower() not in have]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def stamp(df: DataFrame, run: RunTime, grain: str = "day", hour_column: str = "day_hour") -> DataFrame:
    """Append the run-date partition keys: ``month`` and ``day``, and the second-exact key for grain ``hour``.

    Keys are text. ``hour_column='hour'`` gives the short form, the time of day alone.
    """
    run = as_datetime(run)
    keys = {"month": f"{run:%Y%m}", "day": f"{run:%Y%m%d}"}
    if grain == "hour":
        keys[hour_column] = f"{run:%H%M%S}" if hour_column == "hour" else f"{run:%Y%m%d%H%M%S}"
    return df.select("*", *[F.lit(value).alias(name) for name, value in keys.items()])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.select("*", *[F.lit(value).alias(name) for name, value in values.items()])


def prefixed_key(col: Column, prefix: str) -> Column:
    """``prefix`` followed by the number; NULL stays NULL."""
    return F.concat(F.lit(prefix), col.cast("string"))


def stripped_key(col: Column, prefix: str) -> Column:
    """What follows the prefix, however long."""
    return F.substr(col, F.lit(len(prefix) + 1))


def contains_any(col: Column, needles: Sequence[str]) -> Column:
    """``col`` holds at least one of the texts, taken literally."""
    found = col.contains(needles[0])
    for needle in needles[1:]:
        found = found | col.contains(needle)
    return found


def clean_name(name: str) -> str:
    return re.sub(r"\s+", "_", re.sub(r"[()]", "_", name))


def clean_header(df: DataFrame) -> DataFrame:
    """Brackets and runs of blanks in column names become underscores; names that then collide are refused."""
    names = [clean_name(name) for name in df.columns]
    seen = [name.lower() for name in names]
    twice = sorted({name for name in seen if seen.count(name) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def timestamps_to_epoch_ms(df: DataFrame) -> DataFrame:
    """Every timestamp column becomes epoch milliseconds, in one projection."""
    return df.select(*[
        epoch_ms(quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else quoted(f.name)
        for f in df.schema.fields
    ])


def with_epoch_ms(
    df: DataFrame,
    columns: Iterable[str],
    replace: bool = False,
    patterns: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add ``<column>_ms`` per date-like column; ``replace`` drops the column itself.

    ``patterns`` names the date forms of columns that do not use the common ones.
    """
    columns, own = list(columns), patterns or {}
    added = [
        epoch_ms(as_timestamp(quoted(c), df.schema[c].dataType, own.get(c, TIMESTAMP_PATTERNS))).alias(f"{c}_ms")
        for c in columns
    ]
    kept = [quoted(c) for c in df.columns if not (replace and c in columns)]
    return df.select(*kept, *added)
