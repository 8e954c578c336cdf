"""The library as one archive, and its way to the executors.

``python -m quotelake.package quotelake.zip`` writes the archive for ``spark-submit --py-files``.
"""

from __future__ import annotations

import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def archive(place: str) -> str:
    """Writes the package's modules to a zip file; returns its path."""
    home = Path(__file__).resolve().parent
    with zipfile.ZipFile(place, "w", zipfile.ZIP_DEFLATED) as out:
        for module in sorted(home.rglob("*.py")):
            out.write(module, str(module.relative_to(home.parent)))
    return place


def ship(spark: SparkSession) -> None:
    """Gives Python workers the package, once for an application: they need not be started where
    the driver can import it from. The file goes through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId not in _shipped and not __file__.endswith(".pyc") and Path(__file__).exists():
        _shipped.add(context.applicationId)
        context.addPyFile(archive(f"{tempfile.mkdtemp(prefix='quotelake-package-')}/quotelake.zip"))


if __name__ == "__main__":
    print(archive(sys.argv[1] if len(sys.argv) > 1 else "quotelake.zip"))
