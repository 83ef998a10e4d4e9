"""Digests of whole published rows; without SQL, which writes doubles in other digits than the JVM."""

from __future__ import annotations

from quaystone.functions import measure
from quaystone.runtime import table


def additive_row_digest(spark, d):
    """As additive_digest, over every column."""
    return measure.additive_digest(measure.row_hashes(table(spark, d, "published_trip")))


def sorted_row_digest(spark, d):
    """As sorted_digest, over every column."""
    return measure.sorted_digest(measure.row_hashes(table(spark, d, "published_trip")))


QUERIES = {f.__name__: f for f in (additive_row_digest, sorted_row_digest)}
ORACLE: dict[str, str] = {}
