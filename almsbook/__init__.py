"""Gift-to-ledger reconciliation and donor analytics as Spark DataFrame plans."""
