"""Named query of the conversation repair."""

from __future__ import annotations

from ..session import table
from .conversation_repair import damaged, repair_report
from .registry import query


@query("op12_conversation_repair")
def op12(spark, folder):
    rows = damaged(table(spark, folder, "conversations"))
    return repair_report(rows, copies_col="copies").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                                           "repaired_sha256")
