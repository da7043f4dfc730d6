"""ledgerloom — bank-ledger analytics (statements, variance, FX, planning, checks) on Spark."""

__version__ = "0.1.0"
