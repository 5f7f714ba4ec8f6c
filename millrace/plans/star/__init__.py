"""Decision-support reports over the retail star."""

from millrace.plans.star import buckets, crosschannel, rollups, simple, subqueries, windows  # noqa: F401
from millrace.plans.star.registry import REPORTS  # noqa: F401
from millrace.plans.star.tables import Star  # noqa: F401
