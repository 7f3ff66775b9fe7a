"""Series analytics and training-data preparation on Spark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package to the Python workers of a session, once; they need it wherever the driver found it.

    The runner that starts a stateful stream reads no files of the session, only the search path of its environment.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    path = f"{tempfile.mkdtemp(prefix='spark-')}/tidemark.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [context.environment.get("PYTHONPATH"), path]))
    _shipped.add(context.applicationId)
