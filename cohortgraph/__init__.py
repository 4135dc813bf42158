"""Country-level social-graph sampling and analytics as Spark DataFrame jobs."""
