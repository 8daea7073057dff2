"""Evidence analytics on Spark: recorded conversations in, linked and reviewed evidence out."""

from __future__ import annotations

import os


def ready(spark) -> None:
    """Lets this session's Python workers import the package from where the driver found it, if PYTHONPATH doesn't already."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [*env.get("PYTHONPATH", "").split(os.pathsep), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in map(os.path.abspath, filter(None, paths)):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
