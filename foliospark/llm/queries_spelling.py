"""Named query of the spelling variants."""

from __future__ import annotations

from ..session import table
from .registry import query
from .spelling import SLIP_RATE, spelling_variants


@query("op13_spelling_variants")
def op13(spark, folder):
    return spelling_variants(table(spark, folder, "documents"), slip_rate=SLIP_RATE)
