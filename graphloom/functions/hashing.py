"""L1: identity hash of a node, ``'r' + sha1hex(str(salt) + str(node))``.

All arguments are Columns or plain strings; everything stays a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def node_hash(salt, node, prefix: str = "r") -> Column:
    """``prefix + sha1(salt || node)`` as lowercase hex."""
    return F.concat(F.lit(prefix), F.sha1(F.concat(_col(salt).cast("string"), _col(node).cast("string"))))


def mint_iri(ns, cls, key) -> Column:
    """Instance IRI ``ns + 'r' + sha1(str(key) + class)`` (key is the salt)."""
    return F.concat(_col(ns), node_hash(key, cls))
