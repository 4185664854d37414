# The registry comes first: the query modules import each other's SQL, and only the
# registry knows their order.
from workpulse.plans import registry  # noqa: F401
