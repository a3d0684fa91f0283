"""Readers of landed files and warehouse tables."""

from skylattice.sources.features import read_features
from skylattice.sources.locations import explode_locations, read_locations
from skylattice.sources.responses import (
    flatten_current, flatten_hourly, read_current, read_hourly, route_rejects,
)
from skylattice.sources.tables import (
    SchemaDriftError, check_schema, read_table, require_schema, schema_drift,
)

__all__ = [
    "SchemaDriftError", "check_schema", "explode_locations", "flatten_current", "flatten_hourly",
    "read_current", "read_features", "read_hourly", "read_locations", "read_table",
    "require_schema", "route_rejects", "schema_drift",
]
