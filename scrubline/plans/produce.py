"""J-4: nested documents -> flat observations -> JSON bytes -> topic/files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import (CORRUPT_COL, ROUTE_COL, VALID, encode_json, flatten_observation,
                              split_valid)


def observations(documents: DataFrame, id_mode: str = "stable") -> DataFrame:
    """Nested weather documents (batch or stream) -> flat observations tagged valid
    or quarantine: a document that did not parse, or without anything to make its id
    from (``{}``, an array, NULL), is no observation."""
    return split_valid(flatten_observation(documents, id_mode=id_mode))


def produce(documents: DataFrame, id_mode: str = "stable") -> DataFrame:
    """The valid observations of ``documents`` as ``value`` bytes, ready for
    ``stream_sink`` / a topic writer. What is no observation is left out: take it
    from :func:`observations`."""
    good = observations(documents, id_mode).filter(F.col(ROUTE_COL) == VALID)
    return encode_json(good.drop(ROUTE_COL, CORRUPT_COL))
