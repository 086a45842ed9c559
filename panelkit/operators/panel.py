"""Panel specification: the entity key and the in-entity order.

Every per-entity operator in this package is a window over
``partitionBy(entity).orderBy(order..., tiebreak...)``. Building all frames
from one spec keeps them in one Exchange + Sort in the physical plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "patient_id"
    order: tuple[str, ...] = ("iculos",)

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(self.entity).orderBy(*self.order)

    def running(self) -> WindowSpec:
        """Rows from the entity's first row up to the current row."""
        return self.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def whole(self) -> WindowSpec:
        """The whole entity. Spark evaluates this frame once per partition,
        unlike ``rowsBetween(currentRow, unboundedFollowing)`` which it
        recomputes for every row."""
        return self.ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def trailing(self, n: int) -> WindowSpec:
        """The current row and the ``n - 1`` rows before it (rows, not hours)."""
        return self.ordered().rowsBetween(-(n - 1), Window.currentRow)

    def group(self) -> WindowSpec:
        return Window.partitionBy(self.entity)


VITAL_PANEL = PanelSpec("patient_id", ("iculos",))
ORDER_PANEL = PanelSpec("o_custkey", ("o_orderdate", "o_orderkey"))
