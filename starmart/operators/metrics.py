"""Metrics that a job collects while it writes."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def collected(observation: Observation) -> dict[str, object]:
    """What the finished job counted; nothing if Spark knew beforehand that there were no rows."""
    try:
        return observation.get
    except Py4JJavaError as e:
        # Spark folds an empty relation away, metrics included, and then has none to hand out.
        if e.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        return {}
