from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.draws import content_hash
from cartwheel.functions.text import escaped


#: Null and the empty text differ, and leading and trailing blanks stay.
LOSSLESS = {"nullValue": "\\N", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, lossless: bool = False) -> None:
    """CSV with a header and no row index; one file per task. Times keep their microseconds.

    Other programs read the plain form, where a text with a line break spans lines and an empty
    text is as good as none. ``lossless`` is for our own reading: line breaks are escaped, so
    files can be split, and every text comes back as it was.
    """
    if lossless:
        df = df.select(*[escaped(F.col(c)).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])
    (df.write.mode("overwrite").options(**(LOSSLESS if lossless else {})).option("header", True).option("escape", '"')
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_time_ordered(df: DataFrame, path: str, files: int, time_col: str = "timestamp",
                       fmt: str = "parquet") -> None:
    """Files that follow one another in time, each sorted inside.

    The sort exists only here. The row's hash takes part in the range bounds, so events that
    share one instant are still spread over files.
    """
    (df.repartitionByRange(files, time_col, content_hash(df))
       .sortWithinPartitions(time_col)
       .write.mode("overwrite").format(fmt).option("header", True).save(path))


def upsert_daily(rows: DataFrame, path: str) -> None:
    """Replace the days present in ``rows``; every other day stays as it is."""
    (rows.repartition("metric_date")   # one file per day
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("metric_date").parquet(path))
