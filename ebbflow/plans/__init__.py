"""Named queries over the driver tables (the ``queries()`` contract)."""

from __future__ import annotations


def registry():
    """All registered queries, importing the modules that define them."""
    from ebbflow.plans import core_queries  # noqa: F401
    from ebbflow.plans.catalog import REGISTRY
    from ebbflow.plans import event_queries  # noqa: F401
    from ebbflow.plans import stream_queries  # noqa: F401
    from ebbflow.plans import state_queries  # noqa: F401
    return REGISTRY
