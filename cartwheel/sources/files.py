"""CSV sources, each with a fixed schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel import schemas
from cartwheel.functions.text import unescaped
from cartwheel.operators.ordering import rows_between
from cartwheel.operators.serving import time_ordered
from cartwheel.session import scratch_folder, settle
from cartwheel.sinks.files import LOSSLESS


def _csv(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    return (spark.read.schema(schema).options(**options)
            .option("header", True)
            .option("enforceSchema", False)   # a header in another order is an error
            .option("escape", '"')            # "" inside a quoted field, as spreadsheets write it
            .csv(path))


def _number(text: Column, kind: str) -> Column:
    """Text as a number, or null; a whole number may be written as 6.0."""
    if kind not in ("int", "bigint"):
        return text.try_cast(kind)
    # each failing cast throws and catches an error per row, so what surely fails is not tried:
    # a text without a digit is no number, and 6.0 is no whole number as it is written
    digits = text.rlike("[0-9]")
    value = F.when(digits & ~text.rlike("^[+-]?[0-9]+[.][0-9]*$"), text.try_cast(kind))
    wide = F.when(digits, text.try_cast("double"))
    return F.coalesce(value, F.when(wide == F.floor(wide), wide.try_cast(kind)))


def _checked(spark: SparkSession, path: str, schema: StructType, names: list[str],
             options: dict[str, str], restore=lambda text: text) -> DataFrame:
    """Rows as typed columns ``names``, with ``reason``, null where every field is of its type, and
    ``raw``, the text of a line that has too few or too many fields.

    The file is read as text, so that a bad field is told from an absent one.
    """
    as_text = StructType([StructField(f.name, StringType()) for f in schema])
    lines = _csv(spark, path, StructType([*as_text.fields, StructField("_raw", StringType())]),
                 columnNameOfCorruptRecord="_raw", **options)
    reason = F.when(F.col("_raw").isNotNull(), "line malformed")
    columns = []
    for field, name in zip(schema, names):
        text, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        value = restore(text) if kind == "string" else _number(text, kind)
        reason = F.coalesce(reason, F.when(text.isNotNull() & value.isNull(), f"{name} malformed"))
        columns.append(value.alias(name))
    return lines.select(*columns, reason.alias("reason"), F.col("_raw").alias("raw"))


def check_invoice_lines(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """Invoice lines with ``reason`` and ``raw``. With ``line_breaks`` a quoted text may span lines;
    a file is then read by one task, as nothing in it tells where a row begins."""
    return _checked(spark, path, schemas.INVOICE_CSV, schemas.INVOICE_LINES.names,
                    {"multiLine": str(line_breaks).lower()})


def _good(checked: DataFrame) -> DataFrame:
    return checked.filter("reason is null").drop("reason", "raw")


def read_invoice_lines(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """The lines that can be read; ``rejected_invoice_lines`` has the others."""
    return _good(check_invoice_lines(spark, path, line_breaks))


def rejected_invoice_lines(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    return check_invoice_lines(spark, path, line_breaks).filter("reason is not null")


def check_dimension(spark: SparkSession, path: str, schema: StructType, lossless: bool = False) -> DataFrame:
    """Rows of a products or users file with ``reason`` and ``raw``, as for invoice lines. A row
    without its key, the first column, is rejected too: it could be upserted nowhere."""
    rows = _checked(spark, path, schema, schema.names, LOSSLESS if lossless else {}, unescaped if lossless else lambda t: t)
    key = schema.names[0]
    return rows.withColumn("reason", F.coalesce("reason", F.when(F.col(key).isNull(), f"{key} missing")))


def read_products(spark: SparkSession, path: str, lossless: bool = False) -> DataFrame:
    """The products that can be read; a bad price or count is never upserted as null."""
    return _good(check_dimension(spark, path, schemas.PRODUCTS, lossless))


def read_users(spark: SparkSession, path: str, lossless: bool = False) -> DataFrame:
    return _good(check_dimension(spark, path, schemas.USERS, lossless))


def rejected_rows(spark: SparkSession, path: str, schema: StructType, lossless: bool = False) -> DataFrame:
    """What ``read_products`` or ``read_users`` leaves out, and why."""
    return check_dimension(spark, path, schema, lossless).filter("reason is not null")


def read_csv(spark: SparkSession, path: str, schema: StructType, lossless: bool = False) -> DataFrame:
    """CSV under a fixed schema; ``lossless`` undoes what ``write_csv`` did under that name."""
    if not lossless:
        return _csv(spark, path, schema)
    frame = _csv(spark, path, schema, **LOSSLESS)
    return frame.select(*[unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                          else F.col(f.name) for f in schema])


def read_event_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Event log in time order, optionally only its first ``limit`` events."""
    log = _csv(spark, path, schemas.EVENT_LOG)
    log = log.withColumn("user_id", F.col("user_id").cast("long"))
    return rows_between(log, ["timestamp"], 0, limit) if limit else time_ordered(log)


def sample_lines(df: DataFrame, fraction: float, seed: int = schemas.SEED,
                 exact: bool = False) -> DataFrame:
    """Sample without replacement; the whole frame when ``fraction`` is 1 or more.

    By default each row is kept on its own draw, in one pass and without a shuffle.
    ``exact`` returns exactly ``round(fraction * rows)`` rows, those with the lowest draws. The
    draws are written out once; the cut is found by counting them in 2**16 ranges, twice, so
    that only the rows of one range in 2**32 are ordered, and the driver sees counts alone.
    """
    if fraction >= 1.0:
        return df
    if not exact:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)

    drawn = settle(df.withColumn("_draw", F.rand(seed)), scratch_folder(df.sparkSession, "sample"))
    ranges, low, width = 1 << 16, 0.0, 1.0
    missing = round(fraction * drawn.count())
    for _ in range(2):
        inside = _between(drawn, low, low + width)
        width /= ranges
        place = F.floor((F.col("_draw") - low) / width).cast("int")
        sizes = {r["place"]: r["count"] for r in inside.groupBy(place.alias("place")).count().collect()}
        cut = 0
        while cut < ranges - 1 and sizes.get(cut, 0) < missing:
            missing -= sizes.get(cut, 0)
            cut += 1
        low += cut * width
    rest = _between(drawn, low, low + width).orderBy("_draw").limit(missing)
    return _between(drawn, 0.0, low).unionByName(rest).drop("_draw")


def _between(drawn: DataFrame, low: float, high: float) -> DataFrame:
    return drawn.filter((F.col("_draw") >= low) & (F.col("_draw") < high))
