"""A place for a user's own enrichment code with a resource per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def enrich_rows(
    df: DataFrame,
    enrich: Callable[[pd.DataFrame, object], pd.DataFrame],
    schema,
    *,
    open_resource: Callable[[], object] = lambda: None,
    close_resource: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """Run ``enrich(frame, resource)`` on batches of rows. The resource is opened and closed once per task.

    Only for enrichment that is no join and no column expression: rows leave the JVM for it.
    """
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for frame in frames:
                yield enrich(frame, resource)
        finally:
            close_resource(resource)

    return df.mapInPandas(work, schema)
