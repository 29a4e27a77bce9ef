"""Session helpers: shipping this package to the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> SparkSession:
    """Give every Python worker this package, once per Spark application.

    Functions passed to ``mapInArrow`` are pickled by reference, so the workers have to be able to import
    the package. The zip travels through Spark's own file server, as ``--py-files`` would do.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lexloom_shipped", False):
        return spark
    # the driver serves this file to executors that join later, so it stays until the application ends
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="lexloom-ship-")), "lexloom_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for top, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(target)
    sc._lexloom_shipped = True
    return spark
