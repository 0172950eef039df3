"""All registered queries and oracles (importing the catalog modules registers them)."""

from __future__ import annotations

from . import catalog
from . import catalog_models  # noqa: F401  (registers part 2)
from . import catalog_io  # noqa: F401  (registers part 3)

REGISTRY = catalog.REGISTRY
ORACLES = catalog.ORACLES
