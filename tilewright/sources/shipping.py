"""The package for Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tilewright


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package's files to the executors' Python workers, once for each context."""
    context = spark.sparkContext
    if not getattr(context, "_tilewright_shipped", False):
        top = os.path.dirname(os.path.abspath(tilewright.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="tilewright-"), "tilewright.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        out.write(file, os.path.join("tilewright", os.path.relpath(file, top)))
        context.addPyFile(path)
        context._tilewright_shipped = True
    return spark
