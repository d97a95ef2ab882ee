"""All checked queries, one module per subject."""

from . import (  # noqa: F401
    modelling_table, models, panels, places, rosters, sources_joins, statistics, windows)
from .core import ORACLES, QUERIES  # noqa: F401
