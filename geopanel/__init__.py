"""Area-panel reconciliation and divergence grading as Spark DataFrame operators."""
