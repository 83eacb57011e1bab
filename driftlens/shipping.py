"""Send this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent


def ship_package(spark: SparkSession) -> None:
    """Once per application: zip the package's sources and register them for Python workers, which
    need not share the driver's folders."""
    context = spark.sparkContext
    if getattr(context, "_driftlens_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="driftlens-")) / "driftlens.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for path in sorted(ROOT.rglob("*.py")):
            bundle.write(path, path.relative_to(ROOT.parent))
    context.addPyFile(str(target))
    context._driftlens_shipped = True
