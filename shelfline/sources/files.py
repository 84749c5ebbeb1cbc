"""File and table sources: CSV with a declared schema, dataset routing,
landed JSON with struct flattening, registered tables."""

from __future__ import annotations

import csv
import posixpath
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S
from ..operators.upsert import LOAD_ORDER


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a CSV file (none if it is empty)."""
    line = spark.read.text(path).first()
    return next(csv.reader([line[0].lstrip("\ufeff")])) if line and line[0] else []


def csv_source(spark: SparkSession, path: str, schema: StructType | None = None,
               null_value: str = "NA", corrupt_col: str | None = None,
               load_order: bool = False) -> DataFrame:
    """Header CSV -> typed rows. With a schema nothing is inferred (no extra
    pass over the files): the header is read first and each column gets the
    type declared for its *name*, in whatever order the file has them. A
    declared column the file lacks stays absent; a column that is not
    declared, and files with different headers under one path, are errors.
    ``NA`` and empty fields become NULL; TRUE/FALSE and ISO dates parse to
    BOOLEAN and DATE. With ``corrupt_col`` a line that does not fit keeps its
    raw text in that column (for a quarantine), instead of silently becoming
    NULL fields. ``load_order`` adds a column that orders the rows as the
    files hold them (file, block in the file, row)."""
    reader = (spark.read.option("header", True).option("nullValue", null_value)
              .option("mode", "PERMISSIVE"))
    if schema is None:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        header, declared = csv_header(spark, path), {f.name: f for f in schema.fields}
        unknown = [c for c in header if c not in declared]
        if unknown:
            raise ValueError(f"{path}: columns not in the schema: {unknown}")
        typed = [declared[c] for c in header] if header else schema.fields
        if corrupt_col:
            typed = typed + [StructField(corrupt_col, StringType())]
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        rows = reader.option("enforceSchema", False).schema(StructType(typed)).csv(path)
    if load_order:
        rows = rows.withColumn(LOAD_ORDER, F.struct(
            "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")))
    return rows


def land_csv(df: DataFrame, path: str) -> None:
    """Land ``df`` as the CSV extract ``path`` (header, NA for NULL): a folder
    of part files, each written by the task that holds its rows. It appears
    under its name when it is whole."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, target = hadoop.Path(f"{path}-parts"), hadoop.Path(path)
    df.write.option("header", True).option("nullValue", "NA").csv(folder.toString())
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) or not fs.rename(folder, target):
        raise OSError(f"{path} could not be put in place")


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> list[str]:
    """Paths in ``folder`` matching ``glob``: files, and folders of part files
    (an extract that several tasks wrote), on any file system Spark reads.
    Only names are read, and the list is as long as their number."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .load(folder).select("path"))
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    folders = [s.getPath() for s in found if s.isDirectory()]
    return sorted([r["path"] for r in listing.collect()]
                  + [p.toString() for p in folders if not p.getName().startswith(("_", "."))])


def route_csv(path: str, configs: dict = S.RAW_TABLES) -> str | None:
    """``<dir>/Sales.csv`` -> ``raw_sales`` when that table is configured,
    else None (the file is skipped, not an error)."""
    stem = posixpath.splitext(posixpath.basename(path))[0]
    table = f"raw_{stem.lower()}"
    return table if table in configs else None


def csv_routing(spark: SparkSession, folder: str, configs: dict = S.RAW_TABLES) -> dict:
    """Every configured ``*.csv`` (a file, or a folder of part files) in
    ``folder`` -> (table name, DataFrame)."""
    out = {}
    for path in list_files(spark, folder, "*.csv"):
        table = route_csv(path, configs)
        if table is None:
            continue
        out[table] = csv_source(spark, path, S.RAW_SCHEMAS.get(table))
    return out


def csv_dataset(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Load one configured dataset; a missing file raises (Spark's
    PATH_NOT_FOUND analysis error)."""
    return csv_source(spark, path, S.RAW_SCHEMAS.get(table))


def json_flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """One flat row per record: nested struct fields become columns named by
    their path joined with ``sep``; arrays and scalars are kept as they are.
    Works from the schema alone (no data pass)."""
    cols = []

    def walk(prefix, expr, dtype):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], expr.getField(f.name), f.dataType)
        else:
            cols.append(expr.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], F.col(f"`{f.name}`"), f.dataType)
    return df.select(*cols)


def json_records(spark: SparkSession, path: str, schema: StructType | None = None,
                 sampling_ratio: float = 1.0) -> DataFrame:
    """Landed JSON lines (an API dump). Without a schema it is inferred, as
    a dynamic normaliser would; pass ``schema`` (or a sampling ratio) on big
    inputs to avoid the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path)


def json_schema(texts: DataFrame, value_col: str = "value") -> str | None:
    """DDL of the one struct that all JSON records of ``texts`` fit, merged in
    one pass over all of them (a partial aggregate; no sample). Fields that
    some records lack are part of it; numbers with a fraction are DOUBLE, a
    field that is always null is STRING, one of conflicting types VARIANT."""
    objects = texts.where(F.ltrim(value_col).startswith("{"))
    merged = objects.agg(F.expr(f"schema_of_variant_agg(try_parse_json({value_col}))")).first()[0]
    if merged is None or not merged.startswith("OBJECT<"):
        return None
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", merged)
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)(?=[,>])", "DOUBLE", ddl)
    return re.sub(r"\bVOID(?=[,>])", "STRING", ddl)


def json_drifting(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """Landed JSON lines whose records drift: files with other fields, other
    nesting or none of them. One typed row per record, absent fields NULL; a
    line that is no JSON object gives a row of NULLs. ``ddl`` (see
    ``json_schema``) saves the pass that finds the schema."""
    texts = spark.read.text(path)
    ddl = ddl or json_schema(texts)
    if ddl is None:
        return texts.select()
    record = F.try_variant_get(F.try_parse_json("value"), "$", ddl)
    return texts.select(F.inline_outer(F.array(record)))
