"""Reusable DataFrame operators; each works on any table with the named columns."""

from staylake.operators.history import current_rows, scd2_bulk, scd2_merge
from staylake.operators.hosts import host_room_spread
from staylake.operators.joins import assemble, bounded_broadcast, fold_join
from staylake.operators.kpi import listing_kpis
from staylake.operators.quality import check_unique
from staylake.operators.windows import (first_last, period_change, running_total,
                                        top1_per_group, top_k)

__all__ = [
    "assemble", "bounded_broadcast", "check_unique", "current_rows", "first_last",
    "fold_join", "host_room_spread", "listing_kpis", "period_change",
    "running_total", "scd2_bulk", "scd2_merge", "top1_per_group", "top_k",
]
