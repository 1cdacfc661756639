"""Makes this package importable in the Python workers of any cluster, whatever their PYTHONPATH is."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidegrid


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the job's Python files, once a context; Spark's own file server hands them to executors, late ones too."""
    sc = spark.sparkContext
    if getattr(sc, "_tidegrid_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tidegrid.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidegrid-"), "tidegrid.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.join("tidegrid", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tidegrid_shipped = True
