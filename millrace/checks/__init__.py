"""All registered queries and their SQL twins."""

from . import logs, ordered, scalars, streams, warehouse  # noqa: F401  (fill the registry)
from .registry import ORACLES, QUERIES, load  # noqa: F401
