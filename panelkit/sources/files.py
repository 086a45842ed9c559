"""Entity-file sources (A1-A5): one delimited file per entity, read as one scan.

A directory of per-entity files becomes one CSV scan with an explicit
schema; the entity id comes from the file name through the hidden
``_metadata`` column, so there is no per-file loop on the driver. Malformed
lines are kept apart in a quarantine frame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from panelkit import constants as K

CORRUPT = "_corrupt_record"


def raw_schema(extra_demographics: list[str] | None = None, with_corrupt: bool = True) -> StructType:
    """Explicit schema of a raw entity file (mixed-case names as in the files)."""
    fields = [StructField(c, DoubleType(), True) for c in K.VITALS + K.LABS]
    demo = extra_demographics if extra_demographics is not None else K.DEMOGRAPHICS
    fields += [StructField(c, DoubleType(), True) for c in demo]
    fields += [StructField("ICULOS", IntegerType(), True), StructField("SepsisLabel", IntegerType(), True)]
    if with_corrupt:
        fields.append(StructField(CORRUPT, StringType(), True))
    return StructType(fields)


def read_entity_files(spark: SparkSession, directory: str, sep: str = "|",
                      schema: StructType | None = None, glob: str = "*.psv") -> DataFrame:
    """A1: every ``glob`` file under ``directory`` in one CSV scan (PERMISSIVE).

    Empty files contribute no rows; the header row of each file is skipped.
    """
    schema = schema or raw_schema()
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .option("enforceSchema", False)
            .csv(directory))


def with_entity_from_filename(df: DataFrame, name: str = "patient_id", suffix: str = ".psv") -> DataFrame:
    """A2: entity id = file name without its suffix."""
    pattern = r"^(.*)" + suffix.replace(".", r"\.") + "$"
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A4: (clean rows, malformed rows with their file name and raw text)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    bad = F.col(CORRUPT).isNotNull()
    marked = df.withColumn("_bad", bad)
    clean = marked.filter(~F.col("_bad")).drop("_bad", CORRUPT)
    # a projection of only the corrupt-record column is not allowed on raw
    # CSV scans, so the parsed hour (null on a malformed line) rides along
    data_col = next(c for c in df.columns if c != CORRUPT)
    quarantine = marked.filter(F.col("_bad")).select(
        F.col("_metadata.file_name").alias("file_name"), F.col(CORRUPT).alias("raw_line"),
        F.col(data_col).alias("parsed_first_column"))
    return clean, quarantine


def files_found(df: DataFrame) -> int:
    """Entity files the scan found (from the file index; no job). Zero
    means the source directory or glob is wrong."""
    return len(df.inputFiles())


def entity_inventory(raw: DataFrame) -> DataFrame:
    """Files that contributed at least one line, on the raw scan."""
    return raw.select(F.col("_metadata.file_path").alias("file")).distinct().agg(
        F.count(F.lit(1)).alias("files"))


def read_by_header(spark: SparkSession, directory: str, sep: str = "|", schema: StructType | None = None,
                   glob: str = "*.psv", order: str = "ICULOS") -> tuple[DataFrame, DataFrame]:
    """A1 + A4: entity files read by each file's own header, in any column order.

    Returns (rows with ``file_name`` and the columns of ``schema``, quarantine
    with file_name, raw_line, reason). A column that a file lacks is null; a
    column outside the schema is not read. The header is the line that names
    ``order``; a file without one is quarantined line by line and the others go
    on. So is a line with another number of fields than its header, or with a
    value that is not of the column's type. Empty files give no rows.

    Lines meet their header (one row a file) in a join on the file, which Spark
    broadcasts while it is small; no file is read whole by one task.
    """
    fields = [f for f in (schema or raw_schema(with_corrupt=False)).fields if f.name != CORRUPT]
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(directory)
             .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name"),
                     F.regexp_replace("value", "^\ufeff|\r$", "").alias("raw_line"))
             .filter(F.trim("raw_line") != ""))
    parts = F.split("raw_line", "\\Q" + sep + "\\E", -1)
    lines = lines.withColumn("_values", F.transform(parts, lambda v: F.trim(v)))
    is_header = F.array_contains("_values", order)
    headers = lines.filter(is_header).groupBy("_path").agg(F.min("_values").alias("_names"))
    rows = lines.filter(~is_header).join(headers, "_path", "left")

    # values in the schema's order; the position of a name the header lacks is 0
    names = F.array(*[F.lit(f.name) for f in fields])
    rows = rows.withColumn("_raw", F.transform(names, lambda n: F.nullif(
        F.get("_values", F.array_position("_names", n).cast("int") - 1), F.lit(""))))
    def does_not_read_as(kind: str):
        return lambda i: F.get("_raw", i).isNotNull() & F.get("_raw", i).try_cast(kind).isNull()

    wrong = F.lit(False)
    for kind in {f.dataType.simpleString() for f in fields} - {"string"}:
        at = F.array(*[F.lit(i) for i, f in enumerate(fields) if f.dataType.simpleString() == kind])
        wrong = wrong | F.exists(at, does_not_read_as(kind))
    reason = (F.when(F.col("_names").isNull(), F.lit("no header"))
              .when(F.size("_values") != F.size("_names"), F.lit("number of fields"))
              .when(wrong, F.lit("value")))
    rows = rows.withColumn("reason", reason)
    clean = rows.filter(F.col("reason").isNull()).select(
        "file_name", *[F.get("_raw", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
    return clean, rows.filter(F.col("reason").isNotNull()).select("file_name", "raw_line", "reason")


def read_panel_files(spark: SparkSession, directory: str, sep: str = "|") -> tuple[DataFrame, DataFrame]:
    """A1+A2+A4+B1: raw entity files -> (lower-case panel with entity id, quarantine).

    The in-entity order is the ``iculos`` column (A3); physical file order is
    never relied on.
    """
    from panelkit.operators.clean import nan_to_null, normalize_columns
    clean, quarantine = read_by_header(spark, directory, sep)
    named = clean.withColumn("patient_id", F.regexp_extract("file_name", r"^(.*)\.psv$", 1)).drop("file_name")
    return nan_to_null(normalize_columns(named)), quarantine


def read_clean_files(spark: SparkSession, directory: str, schema: StructType | None = None,
                     glob: str = "*.psv") -> DataFrame:
    """A5: cleaned files written comma-delimited."""
    return read_entity_files(spark, directory, ",", schema, glob)
