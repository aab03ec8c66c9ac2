"""Raw files under their declared layouts; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import day_first_date
from ..schemas import CUSTOMER_BRONZE, ORDER_BRONZE, PRODUCT_BRONZE

SOURCE_FOLDER = "source_data"
DATE_COLUMNS = ("Order Date", "Ship Date")


CORRUPT = "_corrupt_record"
# Between "lines" of a file that is one document: it has a control character, which no JSON text holds.
NO_LINE_END = "\x00salesmill-end-of-document-7d1f4b52\x00"
# Counts taken while records are read, beside one for each column.
RECORDS, WHOLE_RECORD = "__records", "__out_of_shape"
REPORT = {"source": "string", "records": "bigint", "rejected": "bigint", "field": "string"}


def load_customer_data(
    spark: SparkSession,
    file_path: str | None = None,
    file_format: str = "csv",
    multi_line: bool = False,
    corrupt_column: str | None = None,
    rejects: Observation | None = None,
) -> DataFrame:
    """Customers from CSV with a header, or from Parquet.

    A workbook has to be saved as CSV first: it can only be opened whole, on one machine.
    Quotes within a value are doubled, as RFC 4180 has them. ``multi_line=True`` reads values
    with line breaks; such files are one task each. Records that do not fit the header raise
    when they are read, or are kept in ``corrupt_column`` if one is named. ``rejects`` takes
    counts for ``rejects_report`` while the rows are read; Parquet has its types and rejects nothing.
    """
    path = file_path or f"{SOURCE_FOLDER}/Customer.csv"
    if file_format == "csv":
        return _read_csv(spark, CUSTOMER_BRONZE, path, multi_line, corrupt_column, rejects)
    stored = spark.read.schema(CUSTOMER_BRONZE).format(file_format).load(path)
    return stored.observe(rejects, F.count(F.lit(1)).alias(RECORDS)) if rejects else stored


def load_product_data(
    spark: SparkSession,
    file_path: str | None = None,
    multi_line: bool = False,
    corrupt_column: str | None = None,
    rejects: Observation | None = None,
) -> DataFrame:
    """Products from CSV with a header; options as for customers."""
    path = file_path or f"{SOURCE_FOLDER}/Products.csv"
    return _read_csv(spark, PRODUCT_BRONZE, path, multi_line, corrupt_column, rejects)


def load_order_data(
    spark: SparkSession,
    file_path: str | None = None,
    multi_line: bool = False,
    corrupt_column: str | None = None,
    rejects: Observation | None = None,
) -> DataFrame:
    """Orders from JSON, both dates parsed.

    By default a file holds one order per line and can be split. ``multi_line=True`` reads
    documents (an array of orders per file), one task per file. Neither form passes for the
    other: lines that are no order raise when they are read (or are kept in
    ``corrupt_column``), and a file of lines read as documents is refused at once. A date that
    is malformed counts among the ``rejects`` as a value of the wrong type does.
    """
    path = file_path or f"{SOURCE_FOLDER}/Orders.json"
    if multi_line:
        _refuse_lines(spark, path)
    reader = spark.read.schema(_as_text(ORDER_BRONZE)).option("columnNameOfCorruptRecord", CORRUPT)
    # A document is read as one long line. Spark's multiLine reader goes back to the file for every number
    # that is read as text, opening it each time; a line is in memory already.
    text = (reader.option("lineSep", NO_LINE_END) if multi_line else reader).json(path)
    dates = {name: day_first_date(f"`{name}`") for name in DATE_COLUMNS}
    return _typed(text, ORDER_BRONZE, corrupt_column, rejects, dates)


def _read_csv(
    spark: SparkSession,
    schema: StructType,
    path: str,
    multi_line: bool,
    corrupt_column: str | None,
    rejects: Observation | None,
) -> DataFrame:
    text = (
        spark.read.schema(_as_text(schema)).option("header", True)
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )
    return _typed(text, schema, corrupt_column, rejects, {})


def _as_text(schema: StructType) -> StructType:
    """All columns as text and one for records out of shape: a value of the wrong type is
    then no fault of the record."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(CORRUPT, StringType())])


def _typed(
    text: DataFrame,
    schema: StructType,
    corrupt_column: str | None,
    rejects: Observation | None,
    parsed: dict[str, Column],
) -> DataFrame:
    """Declared types, null where a value does not have its type; corrupt records raise, or
    go to a column. ``parsed`` are columns that are read otherwise."""
    # A reader that is asked for few columns does not look whether records have them all, so
    # what tells corrupt records reads every column: nothing of it, but the planner can't know.
    other = F.substring(F.concat_ws("", *[F.col(f"`{f.name}`") for f in schema.fields]), 1, 0)
    corrupt = F.concat(F.col(CORRUPT), other)
    typed = {f.name: parsed.get(f.name, F.col(f"`{f.name}`").try_cast(f.dataType)) for f in schema.fields}
    if rejects:
        nulled = {
            name: F.count_if(corrupt.isNull() & F.col(f"`{name}`").isNotNull() & value.isNull())
            for name, value in typed.items()
        }
        text = text.observe(
            rejects, F.count(F.lit(1)).alias(RECORDS), F.count(corrupt).alias(WHOLE_RECORD),
            *[count.alias(name) for name, count in nulled.items()],
        )
    if not corrupt_column:
        message = F.concat(F.lit("record does not fit its layout: "), F.substring(corrupt, 1, 200))
        text = text.where(F.when(corrupt.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
    columns = [value.alias(name) for name, value in typed.items()]
    return text.select(*columns, *([corrupt.alias(corrupt_column)] if corrupt_column else []))


def rejects_report(spark: SparkSession, observed: dict[str, Observation]) -> DataFrame:
    """``source, records, rejected, field``: what loads could not take, from the passes that loaded it.

    A row for the records out of shape of each source (``field`` is null) and one for each column
    that a value had to be nulled in, as it was not of the column's type. Waits until each source's
    rows have been read once; ask for it after the load.
    """
    rows = []
    for source, observation in observed.items():
        counts = dict(observation.get)
        records, out_of_shape = counts.pop(RECORDS), counts.pop(WHOLE_RECORD, 0)
        rows.append((source, records, out_of_shape, None))
        rows += [(source, records, count, field) for field, count in counts.items() if count]
    told = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, REPORT.items())]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*told)))


def _refuse_lines(spark: SparkSession, path: str) -> None:
    """A file of several lines, each an object or array by itself, is no document: read as
    one it would give what its first line holds."""
    value = F.trim("value")
    alone = F.count_if(value.rlike(r"^(\{.*\}|\[.*\])$"))
    counted = spark.read.text(path).where(value != "").groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("lines"), alone.alias("alone")
    )
    lines = counted.where("lines > 1 and alone = lines").select("file").head(1)
    if lines:
        raise ValueError(f"{lines[0].file} has one order per line; read it with multi_line=False")


def parse_order_dates(df: DataFrame, columns: tuple[str, ...] = DATE_COLUMNS) -> DataFrame:
    """Turn day-first text into dates, in place; malformed text becomes null."""
    return df.withColumns({name: day_first_date(f"`{name}`") for name in columns})
