"""The package itself for the executors' Python: they needn't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's code to all executors, once an application."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="leafgraph-code-")) / "leafgraph.zip"  # on the driver; executors fetch it from there
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SENT.add(context.applicationId)
