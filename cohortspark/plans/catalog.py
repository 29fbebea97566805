"""Imports every query module so that the registry is complete."""

from . import queries  # noqa: F401
from . import queries_ingest  # noqa: F401
from . import queries_stats  # noqa: F401
from . import queries_eval  # noqa: F401
from . import queries_ml  # noqa: F401
