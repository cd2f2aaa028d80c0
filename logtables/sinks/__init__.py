"""Table writers and the run ledger."""
