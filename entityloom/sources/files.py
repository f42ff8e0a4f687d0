"""Files under a dated output directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.sources.shared import write_options

# The tokens an output directory may hold, and the part of the
# time each one stands for.
DATE_TOKENS = {
    "YYYY": ("year", "yyyy"),
    "MM": ("month", "MM"),
    "DD": ("day", "dd"),
    "HH": ("hour", "HH"),
    "mm": ("minute", "mm"),
}


def split_directory(directory: str) -> tuple[str, list[str]]:
    """The fixed part of a dated directory and its tokens.

    The tokens must be the last path segments: ``out/orders/YYYY/MM/``.
    """
    segments = directory.rstrip("/").split("/")
    tokens: list[str] = []
    while segments and segments[-1] in DATE_TOKENS:
        tokens.insert(0, segments.pop())
    if any(s in DATE_TOKENS for s in segments):
        raise ValueError(f"date tokens must end the directory: {directory}")
    if len(set(tokens)) != len(tokens):
        raise ValueError(f"a date token occurs twice: {directory}")
    return "/".join(segments), tokens


def write_by_date(df: DataFrame, directory: str, time_column: str) -> str:
    """Write ``df`` as JSON, one directory per value of the tokens in ``directory``.

    The directories are named ``year=2001/month=05``, so that reading the fixed
    part, which is returned, gives the parts back as columns.  Rows are first
    gathered by directory; AQE splits a directory that holds much of the data
    over several tasks.
    """
    root, tokens = split_directory(directory)
    parts = [DATE_TOKENS[t] for t in tokens]
    dated = df.withColumns(
        {name: F.date_format(time_column, pattern) for name, pattern in parts}
    )
    names = [name for name, _ in parts]
    if names:
        dated = dated.hint("rebalance", *names)
    writer = dated.write.options(**write_options(df.sparkSession, root))
    writer.mode("errorifexists").partitionBy(*names).json(root, ignoreNullFields=False)
    return root
