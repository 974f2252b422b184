"""Parquet scans over period folders and period-partitioned parquet tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaextract.functions import path_to_period

#: Column with the period of the folder that a row was read from.
READ_PERIOD = "source_period"

# Types that hold all values of those before them.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_FLOATING = (T.FloatType(), T.DoubleType())


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, also inside arrays, maps and structs of the same fields; None if there is none."""
    if a == b:
        return a
    for kinds in (_WHOLE, _FLOATING):
        if a in kinds and b in kinds:
            return max(a, b, key=kinds.index)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = _wider(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = _wider(a.keyType, b.keyType), _wider(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        kinds = [_wider(x.dataType, y.dataType) for x, y in zip(a, b, strict=True)]
        return T.StructType([T.StructField(n, k) for n, k in zip(a.names, kinds, strict=True)]) if all(kinds) else None
    return None


@dataclass
class SchemaGroup:
    """Folders and files that can be read under one schema."""

    schema: T.StructType
    paths: list[str]

    def agrees_with(self, schema: T.StructType) -> bool:
        known = {f.name: f.dataType for f in self.schema}
        return all(known.get(f.name, f.dataType) == f.dataType for f in schema)

    def add(self, other: SchemaGroup) -> None:
        self.schema = T.StructType([*self.schema, *(f for f in other.schema if f.name not in self.schema.names)])
        self.paths += other.paths


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """One schema for all files, read from their footers in parallel; None if they have columns of different types."""
    try:
        return _nullable(spark.read.option("mergeSchema", True).parquet(*paths).schema)
    except Exception as error:  # an error of Spark's that has no class of its own in Python
        if "[CANNOT_MERGE_SCHEMAS]" not in str(error):
            raise
        return None


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _files(spark: SparkSession, folder: str) -> list[str]:
    """The files of a folder, oldest first: those before and after a change of a writer's types are then neighbours."""
    listed = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/*.parquet").select("path", "modificationTime")
    return [r.path for r in listed.orderBy("modificationTime", "path").collect()]


def _groups(spark: SparkSession, files: Sequence[str]) -> Iterable[SchemaGroup]:
    schema = _merged(spark, files)
    if schema is not None:
        yield SchemaGroup(schema, list(files))
    else:
        # A single file always has a schema. Halving finds a change of types in a logarithmic number of parallel footer reads.
        half = len(files) // 2
        yield from _groups(spark, files[:half])
        yield from _groups(spark, files[half:])


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[SchemaGroup]:
    """The folders' files, grouped so that within a group each column has one type. Usually this is one group, named by its folders.

    A folder whose files disagree is listed file by file. There are as many groups as there are combinations of conflicting types, however many folders there are.
    """
    groups: list[SchemaGroup] = []
    for path in paths:
        schema = _merged(spark, [path])
        found = [SchemaGroup(schema, [path])] if schema is not None else _groups(spark, _files(spark, path))
        for more in found:
            for group in groups:
                if group.agrees_with(more.schema):
                    group.add(more)
                    break
            else:
                groups.append(more)
    return groups


def _common(groups: Sequence[SchemaGroup]) -> T.StructType:
    fields: dict[str, T.DataType] = {}
    for group in groups:
        for found in group.schema:
            known = fields.setdefault(found.name, found.dataType)
            wider = _wider(known, found.dataType)
            if wider is None:
                raise ValueError(f"{group.paths[0]}: column {found.name} is {found.dataType.simpleString()}, elsewhere {known.simpleString()}")
            fields[found.name] = wider
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def period_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """Union of the schemas of all files below the folders, by column name; whole and floating numbers become the wider type.

    Any other difference of types is an error that names the column and a place where it has its type. Spark reads the footers of a folder in parallel.
    """
    return _common(schema_groups(spark, paths))


def _read(spark: SparkSession, group: SchemaGroup, schema: T.StructType) -> DataFrame:
    """A group under its own schema, then cast to the common one; columns that need no cast stay plain, so that filters reach the scan."""
    own = {f.name: f.dataType for f in group.schema}
    rows = spark.read.schema(group.schema).parquet(*group.paths)

    def column(field: T.StructField) -> Column:
        if field.name not in own:
            return F.lit(None).cast(field.dataType).alias(field.name)
        plain = F.col(f"`{field.name}`")
        return plain if own[field.name] == field.dataType else plain.cast(field.dataType).alias(field.name)

    period = path_to_period(F.col("_metadata.file_path")).alias(READ_PERIOD)
    return rows.select(*[column(f) for f in schema if f.name != READ_PERIOD], period)


def read_periods(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, *, with_period: bool = False) -> DataFrame:
    """Scan several period folders under the schema of :func:`period_schema`; a folder that lacks a column yields null there.

    Without any path the result is an empty frame of ``schema``. ``with_period`` adds ``source_period``, the period of the folder each row lies in (in place of a column of that name).
    """
    if not paths:
        if schema is None:
            raise ValueError("no folders to read and no schema for an empty frame")
        fields = [f for f in schema if not with_period or f.name != READ_PERIOD]
        return spark.createDataFrame([], T.StructType([*fields, *[T.StructField(READ_PERIOD, T.StringType())] * with_period]))
    groups = schema_groups(spark, paths)
    common = _common(groups)
    if with_period:
        return reduce(DataFrame.unionByName, [_read(spark, g, common) for g in groups])
    if len(groups) == 1:
        return spark.read.schema(common).parquet(*groups[0].paths)
    return reduce(DataFrame.unionByName, [_read(spark, g, common).select(*[F.col(f"`{n}`") for n in common.names]) for g in groups])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a table under a declared schema; a path that does not exist is an empty table. Other errors are raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_by_period(frame: DataFrame, path: str, fy: str, mode: str = "overwrite") -> None:
    """Write partitioned by FY. Rebalancing on FY keeps file counts low and splits periods that are much larger."""
    frame.hint("rebalance", fy).write.mode(mode).partitionBy(fy).parquet(path)
