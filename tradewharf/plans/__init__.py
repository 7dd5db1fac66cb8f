"""Models of the lakehouse. Importing this package registers all of them."""

from tradewharf.plans import dims, facts, reports, staging  # noqa: F401
