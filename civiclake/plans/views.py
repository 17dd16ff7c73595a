"""SQL over the stored tables."""

from __future__ import annotations

from civiclake.schemas import TABLES
from civiclake.sources.tables import Store


def register_views(store: Store, prefix: str = "") -> None:
    """A temporary view for every stored table, so reports can be written as ``spark.sql`` text."""
    for name in TABLES:
        if store.exists(name):
            store.read(name).createOrReplaceTempView(f"{prefix}{name}")
