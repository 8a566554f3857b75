"""dqforge: data-quality checks, audits and publishing on Spark DataFrames.

Most used entry points::

    from dqforge import run_checks, gate, validate, write_audit_publish
"""

from .operators.checks import (  # noqa: F401
    CheckFailed,
    check_row,
    column_checks,
    gate,
    ground_truth_check,
    interval_check,
    row_flags,
    row_rules,
    run_checks,
    spot_check,
    table_checks,
    threshold_check,
    value_check,
)
from .operators.expectations import load_suite, run_checkpoint, run_checkpoint_config, validate, validate_tiers  # noqa: F401
from .operators.integrity import diff_tables, file_checksums, table_fingerprint  # noqa: F401
from .operators.publish import publish_new, write_audit_publish  # noqa: F401
from .operators.registry import load_registry, resolve_schema  # noqa: F401
from .results import RESULT_COLUMNS  # noqa: F401
