"""Deliveries whose columns change: what differs, a schema that holds both, and a column for what does not fit.

Nothing that arrives is lost: a field that the schema does not know, or a value that its column cannot hold, is kept as
JSON in ``_rescued``, by its name and as the text it came as.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from liftlab.sources import files

RESCUED = "_rescued"
_WHOLE = [ByteType, ShortType, IntegerType, LongType]
_REPORT = "column STRING, change STRING, feed_type STRING, delivered_type STRING"


def widened(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds all values of both; text if there is no other."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, FloatType, DoubleType}:
        # a float holds whole numbers up to a short, a double up to an int
        if LongType in kinds:
            return DecimalType(38, 18)
        return FloatType() if kinds <= {ByteType, ShortType, FloatType} else DoubleType()
    if kinds <= {*_WHOLE, DecimalType}:
        a, b = (t if isinstance(t, DecimalType) else DecimalType(19, 0) for t in (a, b))
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= 38 else StringType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds == {DateType, TimestampType}:
        return TimestampType()
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return evolve(a, b, add_columns=True)
    return StringType()


def evolve(feed: StructType, delivered: StructType, add_columns: bool = False) -> StructType:
    """The feed's columns in their order, wide enough for the delivery; with ``add_columns`` also those that are new."""
    theirs = {f.name: f.dataType for f in delivered.fields}
    own = [StructField(f.name, widened(f.dataType, theirs.get(f.name, f.dataType)), True, f.metadata) for f in feed.fields]
    new = [f for f in delivered.fields if f.name not in feed.fieldNames()] if add_columns else []
    return StructType([*own, *new])


@dataclass(frozen=True)
class Change:
    """change: added or missing; wider, if the feed's column has to grow; narrower, if it holds the delivery as it is."""

    column: str
    change: str
    feed_type: str | None
    delivered_type: str | None


def compare(feed: StructType, delivered: StructType) -> list[Change]:
    """All columns in which a delivery differs from its feed, in the feed's order and then the delivery's."""
    ours, theirs = ({f.name: f.dataType for f in s.fields} for s in (feed, delivered))
    found = []
    for name, kind in ours.items():
        if name not in theirs:
            found.append(Change(name, "missing", kind.simpleString(), None))
        elif theirs[name] != kind and not isinstance(theirs[name], NullType):
            change = "narrower" if widened(kind, theirs[name]) == kind else "wider"
            found.append(Change(name, change, kind.simpleString(), theirs[name].simpleString()))
    return found + [Change(n, "added", None, k.simpleString()) for n, k in theirs.items() if n not in ours]


def report(spark: SparkSession, changes: Sequence[Change]) -> DataFrame:
    return files.from_rows(spark, [(c.column, c.change, c.feed_type, c.delivered_type) for c in changes], _REPORT)


def _read_as(text: Column, kind: DataType) -> Column:
    """A value of ``kind`` from its text, NULL if it is none."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, (ArrayType, StructType, MapType)):
        return F.from_json(text, kind, {"mode": "PERMISSIVE"})
    if isinstance(kind, BooleanType):
        return F.when(F.lower(text).isin("true", "false"), F.lower(text).try_cast(kind))
    if isinstance(kind, DateType):  # a cast would drop a time of day
        return F.when(text.rlike("^\\s*[0-9]+-[0-9]+-[0-9]+\\s*$"), text.try_cast(kind))
    if isinstance(kind, DecimalType):  # a cast would round
        return F.when(text.try_cast(kind) == text.try_cast(DecimalType(38, 18)), text.try_cast(kind))
    return text.try_cast(kind)


def _fitted(source: DataFrame, raw: Column, schema: StructType, keep: Sequence[str]) -> DataFrame:
    """Columns of ``schema`` from the map ``raw`` (name to text), and what is left of it as JSON."""
    named = source.withColumn("_raw", raw)
    values = {f.name: _read_as(F.get(F.array(F.col("_raw")[f.name]), F.lit(0)), f.dataType) for f in schema.fields}
    lost = F.array_compact(F.array(*[
        F.when(value.isNull() & F.col("_raw")[name].isNotNull(), F.lit(name)) for name, value in values.items()]))
    known = F.array(*[F.lit(name) for name in schema.fieldNames()])
    rest = F.map_filter("_raw", lambda name, text: text.isNotNull() & (
        ~F.array_contains(known, name) | F.array_contains(lost, name)))
    return named.select(*[value.alias(name) for name, value in values.items()],
                        F.when(F.size(rest) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(rest))))).alias(RESCUED), *keep)


def fit_json(lines: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON lines (column ``value``, batch or stream) as columns of ``schema``, ``_rescued`` and ``_corrupt_record``.

    A field that is null or missing is NULL and not rescued; a line that is no JSON object is kept as it came. Nested values
    are rescued as their JSON text, names in order.
    """
    parsed = F.from_json("value", "map<string,string>")
    fitted = _fitted(lines.where("length(trim(value)) > 0"), parsed, schema, ["value", "_raw", *keep])
    return fitted.select(*schema.fieldNames(), RESCUED, F.when(F.col("_raw").isNull(), F.col("value")).alias(files.CORRUPT), *keep)


def fit_columns(df: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """A delivery with columns of its own, such as one folder of CSV with header, as columns of ``schema`` and ``_rescued``."""
    pairs = [part for c in df.columns if c not in keep
             for part in (F.lit(c), F.to_json(F.col(c)) if isinstance(df.schema[c].dataType, (ArrayType, StructType, MapType))
                          else F.col(c).cast("string"))]
    return _fitted(df, F.create_map(*pairs).cast("map<string,string>"), schema, keep)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return fit_json(spark.read.text(path), schema)
