"""Date-ranged sales totals, table reconciliation and data-quality checks as Spark DataFrame jobs."""
