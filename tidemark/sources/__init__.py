from .keystore import KeyRegistry
from .latest import LatestRows
from .raw import ingest_raw, land_raw, raw_rejects, read_raw
from .tables import publish, read_table, reset_layer, write_table
from .versions import Versions

__all__ = [
    "KeyRegistry",
    "LatestRows",
    "Versions",
    "ingest_raw",
    "land_raw",
    "publish",
    "raw_rejects",
    "read_raw",
    "read_table",
    "reset_layer",
    "write_table",
]
