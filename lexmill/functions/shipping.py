"""Sends this package to the Python workers of a session, so that jobs run from any working folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package's sources to the session's Python files, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _sent:
        root = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="lexmill-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(archive))
        _sent.add(sc.applicationId)
    return spark
