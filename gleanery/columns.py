"""Names for helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(name: str, *frames: DataFrame) -> str:
    """The name, or one made longer until no column of the frames has it; case doesn't tell names apart, as in Spark."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
