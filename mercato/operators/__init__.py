"""Operators Spark lacks as a single call, written as DataFrame compositions."""

from mercato.operators.ntile import ntile, ntile_window  # noqa: F401
from mercato.operators.quality import (  # noqa: F401
    unique_check, not_null_check, accepted_values_check, quality_report,
)
