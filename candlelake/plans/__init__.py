"""Composite runs: full reload and incremental load, each one write job plus observed metrics."""

from .full_reload import reload_values, run_full_reload
from .incremental import run_incremental

__all__ = ["reload_values", "run_full_reload", "run_incremental"]
