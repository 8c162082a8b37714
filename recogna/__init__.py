"""Revenue-contract analytics expressed as Spark DataFrame jobs."""
