"""DataFrame -> DataFrame operators."""

from abode.operators import churn, enrich, reports, snapshot  # noqa: F401
