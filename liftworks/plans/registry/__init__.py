"""Named queries over the shared tables, with the SQL they are checked against."""

from liftworks.plans.registry import (  # noqa: F401
    encoding,
    evaluation,
    explanation,
    modelling,
    preparation,
    roundtrips,
    runs,
)
from liftworks.plans.registry.core import ORACLES, QUERIES  # noqa: F401
