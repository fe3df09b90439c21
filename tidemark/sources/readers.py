"""Scans: delimited files, event tables, documents, outbox, topic, pages, objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.names import snake_case, unique_names


#: A noncharacter in the names of columns that are added to those of a file, which then never clash.
OWN = "\ufdd0"


def csv_reader(spark: SparkSession, delimiter: str, multi_line: bool, keep_empty: bool):
    reader = spark.read.option("header", True).option("delimiter", delimiter).option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    return reader.option("nullValue", "\0") if keep_empty else reader


def csv_columns(reader, path: str, schema: StructType) -> tuple[list[StructField], dict[str, str]]:
    """The columns of a file with the types of the schema, and the name in the file of each column of the schema."""
    header = reader.csv(path).columns
    named = dict(zip(unique_names(map(snake_case, header)), header))
    missing = [f.name for f in schema if f.name not in named]
    if missing:
        raise ValueError(f"{path} has no column for {', '.join(missing)}; its header is {', '.join(header)}")
    types = {named[f.name]: f.dataType for f in schema}
    return [StructField(h, types.get(h, StringType())) for h in header], named


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, delimiter: str = ",",
    multi_line: bool = False, keep_empty: bool = False,
) -> DataFrame:
    """Delimited text with a header; an empty cell is null.

    ``keep_empty`` reads a quoted empty cell, ``""``, as empty text instead.

    With a schema its columns are found by name: the header is read first and its names,
    normalized, decide which column is which, in any order. A missing column is an error,
    other columns are left out, and a file with another header is an error. Values of another type become
    null; ``csv_rejects`` lists them. Without a schema the types are inferred, which costs a pass over the data.
    ``multi_line`` is for quoted values with line breaks; a file is then one task.
    """
    reader = csv_reader(spark, delimiter, multi_line, keep_empty)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    in_file, named = csv_columns(reader, path, schema)
    rows = reader.option("enforceSchema", False).schema(StructType(in_file)).csv(path)
    return rows.select([quoted(named[f.name]).alias(f.name) for f in schema])


def csv_rejects(
    spark: SparkSession, path: str, schema: StructType, delimiter: str = ",", multi_line: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """``record``, ``column_name``, ``text`` of every cell that ``read_csv`` turns into null because it is of another type.

    The record is the whole line. A line with more or fewer cells than the header has a row with a null column
    and text, as no one cell is at fault. Cells are read by the parser that read them first, so both agree.
    """
    reader = csv_reader(spark, delimiter, multi_line, keep_empty)
    in_file, named = csv_columns(reader, path, schema)
    line, cells = f"line{OWN}", f"cells{OWN}"
    # Cells are counted only if all columns are read.
    reader = reader.option("enforceSchema", False).option("columnPruning", False).option("columnNameOfCorruptRecord", line)
    rows = reader.schema(
        StructType([*in_file, StructField(line, StringType())])).csv(path).where(F.col(line).isNotNull())
    texts = ", ".join(f"`{name}` string" for name in [*range(len(in_file)), line])
    options = {"delimiter": delimiter, "escape": '"', "multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": line}
    options |= {"nullValue": "\0"} if keep_empty else {}
    read = rows.withColumn(cells, F.from_csv(F.col(line), texts, options))
    places = {f.name: i for i, f in enumerate(in_file)}
    damaged = [
        F.when(quoted(named[f.name]).isNull() & F.col(cells)[str(places[named[f.name]])].isNotNull(), F.struct(
            F.lit(f.name).alias("column_name"), F.col(cells)[str(places[named[f.name]])].alias("text")))
        for f in schema if not isinstance(f.dataType, StringType)
    ]
    uneven = F.when(F.col(cells)[line].isNotNull(), F.struct(
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("text")))
    found = F.filter(F.array(uneven, *damaged), lambda cell: cell.isNotNull())
    return read.select(F.col(line).alias("record"), F.explode(found).alias("cell")).select("record", "cell.*")


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``column_name``, ``n``: how many cells of each column were rejected."""
    return rejects.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table by day; filters on event_date skip whole folders."""
    return spark.read.schema(schemas.EVENTS).parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit log by day, with its folder column ``changed_date``."""
    return spark.read.schema(StructType([*schemas.AUDIT.fields, StructField("changed_date", DateType())])).parquet(path)


def stream_events(
    spark: SparkSession, path: str, files_per_batch: int | None = None, schema: str | StructType = schemas.EVENTS
) -> DataFrame:
    """The event table as a stream of the files added to it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_documents(
    spark: SparkSession, path: str | None = None, schema: StructType = schemas.USER_DOCUMENTS,
    fmt: str = "json", options: dict[str, str] | None = None,
) -> DataFrame:
    """Nested documents from files or, by format and options, a document store."""
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def read_outbox(spark: SparkSession, options: dict[str, str], fmt: str = "jdbc") -> DataFrame:
    """Outbox rows. For jdbc give ``partitionColumn`` and its bounds so the table is
    read in parallel; the filter of ``operators.outbox.unsent`` reaches the database.
    """
    return spark.read.format(fmt).options(**options).load()


def read_topic(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka", schema: str | StructType | None = None
) -> DataFrame:
    """Stream with the message text in ``value``; a topic is read from its earliest offset."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load().withColumn("value", F.col("value").cast("string"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_inventory(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """path, length and modificationTime from the listing that an object store delivers as a table;
    unlike ``inventory`` nothing is listed by the driver, so any number of objects will do."""
    return spark.read.format(fmt).schema("path string, length long, modificationTime timestamp").load(path)


def inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, length and modificationTime of every object; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")
