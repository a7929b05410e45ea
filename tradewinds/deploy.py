"""Sends this package to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the files of the session's workers, once an application.

    Workers run elsewhere, or in another folder, and need not have it installed. The driver serves the file.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="tradewinds-")) / "tradewinds.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(str(path))
    _SENT.add(context.applicationId)
