"""Named queries and the SQL that must give the same rows."""

import importlib

from tablewright.checks.registry import CHECKS

MODULES = ("link_checks", "text_checks", "table_checks", "rule_checks", "reshape_checks", "sink_checks", "job_checks", "lookup_checks")


def load() -> dict:
    for name in MODULES:
        importlib.import_module(f"tablewright.checks.{name}")
    return CHECKS
