"""Schema history of a raw feed: columns and types grow with the deliveries, and no value is lost.

Every batch of files is looked at once for its columns. New columns are added to the feed's schema; types widen only
where table files that were written before stay readable under the wider type (whole numbers to larger ones or to
decimals, floats to doubles, objects to objects with more fields). A value that does not fit its column's type
is kept as text in ``_rescued_data``, a JSON object of column names and raw values with the file's path, and so is a
record that cannot be parsed. The schema's versions form a small table of their own; nothing that has been
ingested is ever read again for its schema.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources import versions
from medallion.sources.files import header_groups, with_provenance

RESCUED = "_rescued_data"
_CORRUPT, _PATH = "_corrupt_record", "_file_path"
#: Stands in for the columns of files without any: the reader does not give broken records alone.
_NO_COLUMN = "_no_column"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)
#: What whole numbers of 64 bits become when fractions turn up.
_EXACT = T.DecimalType(38, 18)
#: Above this many digits a double may not hold a whole number.
_DOUBLE_DIGITS = 15
#: A number without leading zeros, which an identifier may have.
_NUMBER = "^[+-]?(0?|[1-9][0-9]*)([.eE]|$)"


def widen(old: T.DataType, new: T.DataType) -> T.DataType:
    """Type of a column that was ``old`` when values of type ``new`` arrive. ``old`` where none holds both."""
    if old == new or isinstance(old, T.StringType):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widen(old.elementType, new.elementType))
    if isinstance(old, T.DecimalType):
        return _wider_decimal(old, new)
    if isinstance(old, _WHOLE):
        if isinstance(new, _WHOLE):
            return max(old, new, key=lambda t: _WHOLE.index(type(t)))
        if isinstance(new, _FLOAT):
            return _EXACT if isinstance(old, T.LongType) else T.DoubleType()
    if isinstance(old, _FLOAT) and isinstance(new, (*_WHOLE, *_FLOAT)):
        return T.DoubleType()
    return old


def _wider_decimal(old: T.DecimalType, new: T.DataType) -> T.DecimalType:
    if isinstance(new, _FLOAT):
        new = _EXACT
    elif isinstance(new, _WHOLE):
        new = T.DecimalType(20, 0)
    elif not isinstance(new, T.DecimalType):
        return old
    scale = max(old.scale, new.scale)
    whole = max(old.precision - old.scale, new.precision - new.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else old


def merge(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with wider types and with the columns that only ``new`` has. Names are told apart regardless of case."""
    fields: dict[str, T.StructField] = {}
    for f in (*old.fields, *new.fields):
        known = fields.get(f.name.lower())
        fields[f.name.lower()] = T.StructField(known.name, widen(known.dataType, f.dataType)) if known else T.StructField(f.name, f.dataType)
    return T.StructType(list(fields.values()))


def _holds(wide: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``new`` can be stored as ``wide``."""
    if wide == new or isinstance(wide, T.StringType):
        return True
    if isinstance(wide, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name.lower(): f.dataType for f in wide.fields}
        return all(f.name.lower() in fields and _holds(fields[f.name.lower()], f.dataType) for f in new.fields)
    if isinstance(wide, T.ArrayType) and isinstance(new, T.ArrayType):
        return _holds(wide.elementType, new.elementType)
    numbers = (*_WHOLE, *_FLOAT, T.DecimalType)
    return isinstance(wide, numbers) and isinstance(new, numbers) and widen(wide, new) == wide


@dataclass(frozen=True)
class SchemaHistory:
    """Versions of a feed's schema, in a table at ``path``: version, schema as JSON, time."""

    spark: SparkSession
    path: str

    def rows(self) -> list:
        """One row per version, oldest first: as many as there were changes."""
        if not versions.exists(self.spark, self.path):
            return []
        return self.spark.read.parquet(versions.current(self.spark, self.path)).orderBy("version").collect()

    def latest(self) -> T.StructType | None:
        rows = self.rows()
        return T.StructType.fromJson(json.loads(rows[-1]["schema"])) if rows else None

    def extend(self, found: T.StructType) -> T.StructType:
        """Schema after a batch with the columns ``found``; recorded as a new version if that changes anything.

        A batch that is repeated finds its own version and changes nothing.
        """
        rows = self.rows()
        old = T.StructType.fromJson(json.loads(rows[-1]["schema"])) if rows else T.StructType([])
        new = merge(old, found)
        if new != old:
            now = self.spark.range(1).select(F.current_timestamp()).first()[0]
            table = [tuple(r) for r in rows] + [(len(rows), new.json(), now)]
            versions.publish(self.spark.createDataFrame(table, "version int, schema string, recorded_at timestamp").coalesce(1), self.path)
        return new

    def table_schema(self) -> T.StructType:
        """Columns of the raw table: the feed's, provenance and rescued values."""
        own = (self.latest() or T.StructType([])).fields
        return T.StructType([*own, *T._parse_datatype_string(f"source_file string, ingestion_timestamp timestamp, {RESCUED} string").fields])


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*(names or [_NO_COLUMN]), _CORRUPT]])


def _read(df: DataFrame) -> DataFrame:
    return with_provenance(df.select("*", F.col("_metadata.file_path").alias(_PATH)))


def _exact(spark: SparkSession) -> SparkSession:
    """A session in which names that differ in case only are different names, as they are in JSON."""
    session = spark.newSession()
    session.conf.set("spark.sql.caseSensitive", "true")
    return session


def raw_json(spark: SparkSession, paths: list[str], multi_line: bool = True) -> tuple[DataFrame, T.StructType]:
    """JSON files with every column as raw text, and the column types found in them."""
    reader = _exact(spark).read.option("multiLine", multi_line).option("columnNameOfCorruptRecord", _CORRUPT)
    found = T.StructType([f for f in reader.json(paths).schema.fields if f.name != _CORRUPT])
    return _read(reader.schema(_texts(found.fieldNames())).json(paths)), found


def raw_csv(spark: SparkSession, paths: list[str], glob: str, infer: bool = False) -> tuple[DataFrame, T.StructType]:
    """CSV files with any headers as text, matched by name, and their columns: text, or with ``infer`` of the type of their values."""
    reader = spark.read.option("header", "true").option("columnNameOfCorruptRecord", _CORRUPT)
    frames, found = [], T.StructType([])
    for names, own in header_groups(spark, paths, glob):
        frames.append(_read(reader.schema(_texts(names)).csv(own)))
        found = merge(found, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    if not frames:
        return _read(reader.schema(_texts([])).csv(paths)), found
    raw = frames[0]
    for frame in frames[1:]:
        raw = raw.unionByName(frame, allowMissingColumns=True)
    return raw, _value_types(raw, found) if infer else found


def _value_types(raw: DataFrame, found: T.StructType) -> T.StructType:
    """The first type that all values of a column fit: whole number, double, boolean, else text. One pass."""
    tried = (T.LongType(), T.DoubleType(), T.BooleanType())
    tests = []
    for i, f in enumerate(found.fields):
        text = F.col(f"`{f.name}`")
        tests += [F.every(text.isNull() | _typed(text, t)[1]).alias(f"{i}_{j}") for j, t in enumerate(tried)]
        tests.append(F.count(text).alias(f"{i}_n"))
    seen = raw.agg(*tests).first()
    fit = lambda i: next((t for j, t in enumerate(tried) if seen[f"{i}_n"] and seen[f"{i}_{j}"]), T.StringType())
    return T.StructType([T.StructField(f.name, fit(i)) for i, f in enumerate(found.fields)])


def _typed(raw: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A raw text as a value of a type, and whether the value says all that the text says."""
    if isinstance(kind, T.StringType):
        return raw, F.lit(True)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        value = F.from_json(raw, kind)
        return value, value.isNotNull()
    text = F.trim(raw)
    value = text.try_cast(kind)
    if isinstance(kind, _WHOLE):
        whole = value.cast("string") == text
    elif isinstance(kind, T.DoubleType):
        digits = text.rlike(f"^[+-]?[0-9]{{{_DOUBLE_DIGITS + 1},}}$")
        whole = text.rlike(_NUMBER) & (~digits | (value.try_cast("decimal(38,0)") == text.try_cast("decimal(38,0)")))
    elif isinstance(kind, T.DecimalType):
        whole = text.rlike(_NUMBER) & (value.cast("double") == text.try_cast("double"))
    elif isinstance(kind, T.BooleanType):
        whole = F.lower(text).isin("true", "false")
    else:
        whole = value.isNotNull()
    return value, value.isNotNull() & F.coalesce(whole, F.lit(False))


def numbers_in_texts(raw: DataFrame, found: T.StructType, known: T.StructType | None) -> T.StructType:
    """``found``, with text columns counted as doubles where the feed has whole numbers and some text is a fraction.

    So a number that one delivery writes as text widens the column like any other. Looks at the batch only if there are such columns.
    """
    whole = {f.name.lower(): f.dataType for f in (known or T.StructType([])).fields if isinstance(f.dataType, _WHOLE)}
    asked = [f.name for f in found.fields if isinstance(f.dataType, T.StringType) and f.name.lower() in whole]
    if not asked:
        return found
    fraction = lambda n: _typed(F.col(f"`{n}`"), T.DoubleType())[1] & F.col(f"`{n}`").rlike("[.eE]")
    seen = raw.agg(*[F.coalesce(F.some(fraction(n)), F.lit(False)).alias(str(i)) for i, n in enumerate(asked)]).first()
    turned = {n for i, n in enumerate(asked) if seen[str(i)]}
    return T.StructType([T.StructField(f.name, T.DoubleType() if f.name in turned else f.dataType) for f in found.fields])


def fit(raw: DataFrame, schema: T.StructType, found: T.StructType) -> DataFrame:
    """Raw text columns under the feed's schema; what does not fit goes to ``_rescued_data``.

    A nested value of a batch in which some nested value has another type than before is rescued as a whole, beside what
    could be read of it.
    """
    spellings: dict[str, list[str]] = {}
    for name in raw.columns:
        spellings.setdefault(name.lower(), []).append(name)
    columns, left = [], []
    for f in schema.fields:
        own = spellings.get(f.name.lower(), [])
        if not own:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.coalesce(*[F.col(f"`{n}`") for n in own])
        value, whole = _typed(text, f.dataType)
        if isinstance(f.dataType, (T.StructType, T.ArrayType)) and not all(
            _holds(f.dataType, new.dataType) for new in found.fields if new.name.lower() == f.name.lower()
        ):
            columns.append(value.alias(f.name))
            left.append(text.alias(f.name))
            continue
        columns.append(F.when(whole, value).alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            left.append(F.when(~whole, text).alias(f.name))
    left += [F.col(c) for c in (_CORRUPT, _NO_COLUMN) if c in raw.columns]
    lost = F.when(F.coalesce(*left).isNotNull(), F.to_json(F.struct(*left, F.col(_PATH))))
    return raw.select(*columns, "source_file", "ingestion_timestamp", lost.alias(RESCUED))
