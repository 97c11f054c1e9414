"""Writers. All replace their target only at the moment they write.

``partitions`` fixes the number of output files; left out, AQE sizes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(df: DataFrame, partitions: int | None) -> DataFrameWriter:
    if partitions:
        df = df.repartition(partitions)
    return df.write.mode("overwrite")


def write_delimited(
    df: DataFrame, path: str, sep: str = "#", compression: str | None = None, partitions: int | None = None
) -> None:
    """Header-less text; NULL and the empty string both become an empty field."""
    writer = (
        _writer(df, partitions)
        .option("sep", sep)
        .option("quote", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partitions: int | None = None, compression: str | None = None) -> None:
    _writer(df, partitions).parquet(path, compression=compression)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], fmt: str = "parquet", gather: bool = True, compression: str | None = None
) -> None:
    """One folder per value of ``by``; only the folders present in ``df`` are replaced.

    The rebalance hint gathers each folder's rows into few files, and AQE
    splits a folder that holds far more rows than the others. Without
    ``gather`` rows stay where they are, a file for each task and folder:
    for few folders of many rows, which needn't move for it.
    """
    writer = (
        (df.hint("rebalance", *by) if gather else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
    )
    if compression:
        writer = writer.option("compression", compression)
    writer.save(path)
