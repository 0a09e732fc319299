"""Source tables and the queries that read them."""

from kvloom.sources.dimensions import Dimension, Dimensions, entity_map, key_map, load_dimensions
from kvloom.sources.tables import (
    CatalogSource,
    FrameSource,
    JdbcSource,
    ParquetSource,
    SourceTables,
)

__all__ = [
    "CatalogSource",
    "Dimension",
    "Dimensions",
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "SourceTables",
    "entity_map",
    "key_map",
    "load_dimensions",
]
