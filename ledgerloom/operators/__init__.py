"""Report and data-check operators over ledger DataFrames."""
