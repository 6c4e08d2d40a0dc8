"""Lookups with a default in small fixed maps.

A map literal keeps the lookup inside the projection: no join, no broadcast, no
shuffle. Meant for the handful of entries of a rate card, not for tables.
"""

from itertools import chain

from pyspark.sql import functions as F


def lookup(key, entries, default=None):
    """entries[key], or the default where the key is absent or null."""
    pairs = [F.lit(v) for v in chain.from_iterable(entries.items())]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def field(entries, position):
    """The same keys with one field of each tuple, as doubles where numeric."""
    return {
        k: float(v[position]) if isinstance(v[position], (int, float)) else v[position]
        for k, v in entries.items()
    }
