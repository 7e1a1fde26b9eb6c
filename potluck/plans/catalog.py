"""Import every query module so that the registry is filled."""

from potluck.plans import q_timeseries  # noqa: F401
from potluck.plans import q_quality  # noqa: F401
from potluck.plans import q_aggregates  # noqa: F401
from potluck.plans import q_enrich  # noqa: F401
from potluck.plans import q_cleaning  # noqa: F401
