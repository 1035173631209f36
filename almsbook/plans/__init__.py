"""Gift, ledger and donor deliverables composed from the operators."""
