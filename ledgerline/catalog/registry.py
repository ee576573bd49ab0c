"""Import point that has all catalog modules register their entries."""

from ledgerline.catalog import (  # noqa: F401
    cleaning,
    measure_checks,
    profile_checks,
    quality_checks,
    relational,
    report_checks,
    scans,
)
from ledgerline.catalog.base import ENTRIES

__all__ = ["ENTRIES"]
