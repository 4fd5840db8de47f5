"""Connected components, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gleanery.llm import shared
from gleanery.operators.graph import connected_components


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). Gives node and component, the least node that it reaches, for each node of an edge."""
    return connected_components(edges, lambda df: shared.written(df, "stars"))
