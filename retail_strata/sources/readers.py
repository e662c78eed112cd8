"""Scans.

With a declared schema, a raw record that the typed columns cannot hold in full is kept
as text in ``raw_record``, which is null otherwise.  A broken line, a bad cell or an
unknown column thus costs typed values, which the silver checks may reject, but never
the record.
"""

import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_strata.functions import quoted

RAW_RECORD = "raw_record"
_UNPARSED = "_unparsed_record"


def _with_text(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in names]])


def _inferred(spark: SparkSession, path: str, kind: str, **options) -> DataFrame | None:
    """The files by their own schema; None for a folder without a data file."""
    try:
        return spark.read.options(**options).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _only_declared(names: list[str]) -> str:
    """A pattern of flat objects without escapes whose keys are all among ``names``: sure of
    those it matches, and cheaper than to look the keys up.  Other lines may be so, too."""
    cell = r'"(?:%s)":(?:"[^"\\]*+"|-?[0-9][-+.0-9eE]*+|true|false|null)' % "|".join(map(re.escape, names))
    return r"^\{%s(?:,%s){0,%d}+\}\z" % (cell, cell, 2 * len(names))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON Lines.  A line that is an array of objects is as many records.  With a schema,
    the records that are no object, have a value of another type or a field that is not
    declared stay in ``raw_record``."""
    if schema is None:
        return spark.read.json(path)
    lines = spark.read.text(path).filter(F.col("value").rlike(r"\S"))
    array, elements = F.ltrim("value").startswith("["), F.from_json("value", "array<string>")
    objects = F.forall(elements, lambda e: F.coalesce(F.ltrim(e).startswith("{"), F.lit(False)))
    records = F.when(array & F.coalesce(objects, F.lit(False)), elements).otherwise(F.array("value"))
    lines = lines.select(F.explode(records).alias("value"))
    known = schema.fieldNames()
    more = F.exists(F.json_object_keys("value"), lambda key: ~key.isin(known))
    record = F.from_json("value", _with_text(schema, _UNPARSED), {"columnNameOfCorruptRecord": _UNPARSED})
    declared = F.col("value").rlike(_only_declared(known))
    unheld = F.col(f"r.{_UNPARSED}").isNotNull() | (~declared & F.coalesce(more, F.lit(True)))
    return lines.select("value", record.alias("r")).select(
        *[F.col(f"r.{quoted(name)}") for name in known], F.when(unheld, F.col("value")).alias(RAW_RECORD)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line.  With a schema the header is checked against it,
    so a file with reordered columns fails instead of loading into the wrong ones.

    Columns that follow the declared ones go to ``raw_record`` as JSON; lines with a
    bad cell or another number of cells as they are.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    header = _inferred(spark, path, "csv", header=True)
    named = [] if header is None else header.columns
    declared = [name.lower() for name in schema.fieldNames()]
    agrees = [name.lower() for name in named[: len(declared)]] == declared
    more = named[len(declared):] if agrees else []
    rows = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _UNPARSED)
        .schema(_with_text(schema, *more, _UNPARSED))
        .csv(path)
    )
    record = F.col(_UNPARSED)
    if more:
        cells = F.to_json(F.struct(*[F.col(quoted(name)) for name in more]))
        record = F.coalesce(record, F.nullif(cells, F.lit("{}")))
    return rows.select(*schema.fieldNames(), record.alias(RAW_RECORD))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with its partition directories.  A schema fixes the types of the
    partition columns, which are otherwise guessed from the directory names."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _by_schema(spark: SparkSession, path: str) -> list[DataFrame]:
    """The files of a folder, those of one schema together.

    Footers are merged by Spark, all at once where they agree.  Where they do not, the
    list of files is halved until each part agrees; parts with the same types are read
    together, so the plan has one scan per schema, however the files are mixed.
    """
    def merged(files: list[str]) -> DataFrame:
        reader = spark.read.option("mergeSchema", True)
        return reader.parquet(*files) if files == [path] else reader.option("basePath", path).parquet(*files)

    def agree(files: list[str]) -> T.StructType | None:
        try:
            return merged(files).schema
        except (PySparkException, Py4JJavaError) as error:  # PySpark has no class for this one
            if "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            return None

    if agree([path]) is not None:
        return [merged([path])]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    waiting = [sorted(r.path for r in listed.load(path).select("path").collect())]
    groups: dict[str, list[str]] = {}
    while waiting:
        files = waiting.pop()
        schema = agree(files)
        if schema is None:
            waiting += [files[: len(files) // 2], files[len(files) // 2 :]]
        else:
            groups.setdefault(schema.simpleString(), []).extend(files)
    return [merged(files) for files in groups.values()]


def read_raw_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by its own types, given in the declared ones; files of a folder may differ
    in their types.

    Where a value does not survive the change of type, or the files have columns that
    are not declared, ``raw_record`` holds the row as JSON.  A missing column fails.
    """
    if schema is None:
        return read_parquet(spark, path)
    if _inferred(spark, path, "parquet") is None:
        return _declared(read_parquet(spark, path, schema), path, schema)
    return reduce(DataFrame.unionByName, [_declared(own, path, schema) for own in _by_schema(spark, path)])


def _declared(own: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    kinds = {f.name.lower(): f.dataType for f in own.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in kinds]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    held = F.lit(len(kinds) == len(schema.fields))
    for field in schema.fields:
        kind = kinds[field.name.lower()]
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            held = F.lit(False)
        elif kind != field.dataType:
            value = F.col(quoted(field.name))
            held = held & value.try_cast(field.dataType).try_cast(kind).eqNullSafe(value)
    record = F.to_json(F.struct(*[F.col(quoted(name)) for name in own.columns]))
    typed = [F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return own.select(*typed, F.when(~held, record).alias(RAW_RECORD))


READERS = {"json": read_json_lines, "csv": read_csv, "parquet": read_raw_parquet}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, so object stores and HDFS work alike."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """Whether a stream wrote the table.  Readers then see only the files in the
    stream's own log, so batch appends to such a table would stay invisible."""
    return path_exists(spark, f"{path}/_spark_metadata")


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table, or None when there is none yet: no such path or, without a schema
    to read an empty folder by, no data file in it.  Any other failure is raised."""
    if not path_exists(spark, path):
        return None
    return _inferred(spark, path, "parquet") if schema is None else read_parquet(spark, path, schema)
