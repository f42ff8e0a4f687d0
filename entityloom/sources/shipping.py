"""The library on executors that do not have it installed."""

from __future__ import annotations

import tempfile
import threading
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import entityloom

SHIPPED: set[str] = set()
SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send this library's sources to the executors, once for each application.

    Where several threads ask, all return after the sources were sent: what a thread hands to
    workers names the files that were sent by then.
    """
    context, home = spark.sparkContext, Path(entityloom.__file__).parent
    with SHIPPING:
        if context.applicationId in SHIPPED or not home.is_dir():
            return
        # The driver serves the file itself; nothing reads this folder on another machine.
        target = Path(tempfile.mkdtemp(prefix="entityloom-")) / "entityloom-sources.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(home.rglob("*.py")):
                archive.write(file, file.relative_to(home.parent))
        context.addPyFile(str(target))
        SHIPPED.add(context.applicationId)
