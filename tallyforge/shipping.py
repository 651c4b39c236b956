"""Sends this package to the workers of a session, so that they can import it wherever the driver has it from."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a context: zip the package and hand it to Spark, which serves it to every executor."""
    context, package = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_tallyforge_shipped", False) or not package.is_dir():
        return
    folder = Path(tempfile.mkdtemp(prefix="tallyforge-")).resolve()
    atexit.register(shutil.rmtree, folder, True)
    path = folder / "tallyforge.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(Path(package.name) / source.relative_to(package)))
    context.addPyFile(str(path))
    context._tallyforge_shipped = True
