"""All registered queries (importing the query modules registers them)."""

from __future__ import annotations

from panelkit.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    from panelkit.plans import q_panel  # noqa: F401
    for mod in ("q_scalar", "q_stats", "q_models", "q_scoring", "q_mining", "q_stream"):
        try:
            __import__(f"panelkit.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"panelkit.plans.{mod}":
                raise
    return dict(REGISTRY)
