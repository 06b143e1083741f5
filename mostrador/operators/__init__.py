"""DataFrame to DataFrame steps: totals, top rows, reconciliation, audit, shaping."""
