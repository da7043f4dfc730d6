"""Table builders: fixed dimensions, calendar, planning model and the order-table ledger adapter."""
