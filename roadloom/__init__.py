"""Road-network graph building and batch routing as Spark DataFrame jobs."""

from __future__ import annotations

import os
import tempfile
import zipfile

_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Give the executors' Python workers this package; needless where it is installed on every node."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="roadloom-ship-"), "roadloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(home):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
