"""Every operator as a query over the driver tables, with a SQL counterpart."""

from lossgrain.queries.registry import ORACLES, QUERIES  # noqa: F401
from lossgrain.queries import (  # noqa: F401
    describing, features, ingest, modelling, monitoring, streams,
)
