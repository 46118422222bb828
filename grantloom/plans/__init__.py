"""Whole jobs: extraction, balances, staffing, payroll reports and the full run."""
