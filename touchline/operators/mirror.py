"""Mirrors: a slice of a source table, deduplicated, typed and keyed, ready to replace the same slice elsewhere."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import (
    apply_mapping, prefixed_key, quoted, read_ddl, timestamps_to_epoch_ms, with_epoch_ms,
)
from touchline.functions.dates import parse_timestamp


@dataclass(frozen=True)
class Mirror:
    """How one table is mirrored.

    columns: target columns and types.
    sources: source names of target columns that are called differently.
    slice_key: source column the run's slice is taken by; None for the whole table.
    account_from: target column the prefixed account key is built from; dropped when ``drop_account_from``.
    timestamps_as_ms: every timestamp column becomes epoch milliseconds.
    ms_added / ms_instead: columns that get a ``_ms`` companion / that it takes the place of.
    ms_in_place / as_timestamps: columns that become epoch milliseconds / timestamps under their own name.
    patterns: date forms of target columns whose text is not written in the common ones, such as day-first dates.
    """

    columns: str
    sources: Mapping[str, str] = field(default_factory=dict)
    slice_key: str | None = "dt"
    account_from: str | None = None
    drop_account_from: bool = False
    timestamps_as_ms: bool = False
    ms_added: tuple[str, ...] = ()
    ms_instead: tuple[str, ...] = ()
    ms_in_place: tuple[str, ...] = ()
    as_timestamps: tuple[str, ...] = ()
    patterns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def mirror(rows: DataFrame, spec: Mirror, prefix: str) -> DataFrame:
    """Dedup over all source columns, then mapping, account key and epoch columns.

    The dedup comes first: the mapping may drop the column in which two rows differ. It hashes whole rows and
    combines copies before the shuffle.
    """
    df = apply_mapping(with_dates(rows.dropDuplicates(), spec), spec.columns, spec.sources)
    if spec.account_from:
        key = prefixed_key(F.col(spec.account_from), prefix)
        df = df.withColumn("account_id", key)
        if spec.drop_account_from:
            df = df.drop(spec.account_from)
    if spec.timestamps_as_ms:
        df = timestamps_to_epoch_ms(df)
    if spec.ms_added:
        df = with_epoch_ms(df, spec.ms_added, patterns=spec.patterns)
    if spec.ms_instead:
        df = with_epoch_ms(df, spec.ms_instead, replace=True, patterns=spec.patterns)
    if spec.ms_in_place:
        names = {f"{c}_ms": c for c in spec.ms_in_place}
        order = df.columns
        df = with_epoch_ms(df, spec.ms_in_place, replace=True, patterns=spec.patterns).withColumnsRenamed(names).select(*order)
    return df.select(*[
        quoted(c).cast("timestamp").alias(c) if c in spec.as_timestamps else quoted(c) for c in df.columns
    ])


def with_dates(rows: DataFrame, spec: Mirror) -> DataFrame:
    """Text of ``spec.patterns`` parsed where the target is a date or timestamp; a target of text keeps its text."""
    targets = {f.name: f.dataType for f in read_ddl(spec.columns).fields}
    parsed = {}
    for column, patterns in spec.patterns.items():
        source = spec.sources.get(column, column)
        if isinstance(rows.schema[source].dataType, T.StringType) and not isinstance(targets[column], T.StringType):
            parsed[source] = parse_timestamp(quoted(source), patterns)
    return rows.withColumns(parsed) if parsed else rows


def replaced_range(target: DataFrame, new: DataFrame, key: str, low: object, high: object) -> DataFrame:
    """The target with its rows of ``low <= key <= high`` given up for the new ones; NULL keys stay."""
    inside = F.coalesce(F.col(key).between(F.lit(low), F.lit(high)), F.lit(False))
    return target.where(~inside).unionByName(new)


def replaced_slice(target: DataFrame, new: DataFrame, key: str, value: object) -> DataFrame:
    return replaced_range(target, new, key, value, value)
