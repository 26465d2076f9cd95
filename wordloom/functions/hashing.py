"""Digests and hash-derived numbers that equal those of other engines bit for bit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(*parts: Column | str, sep: str = "|") -> Column:
    return F.sha2(F.concat_ws(sep, *parts), 256)


def draw(total: int | Column, *parts: Column | str) -> Column:
    """A number from 0 to total - 1, from the first eight hex digits of a SHA-256."""
    return F.conv(F.substring(sha256(*parts), 1, 8), 16, 10).cast("long") % total


def canonical(*columns: str) -> Column:
    """``sha256:`` and the digest of the columns as JSON with sorted keys, nulls included."""
    ordered = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256))


def table_digest(row_digests: Column) -> Column:
    """A digest of a whole table that doesn't depend on the order of its rows.

    Row digests are summed by their first 60 bits and counted, so partial sums combine and no
    list of rows is gathered anywhere.
    """
    number = F.conv(F.substring(row_digests, 1, 15), 16, 10).cast("decimal(38,0)")
    return F.sha2(F.concat_ws("|", F.count("*").cast("string"), F.sum(number).cast("string")), 256)
