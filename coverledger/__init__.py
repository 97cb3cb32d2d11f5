"""Insurance reporting on Spark: landing, curated tables and KPI marts."""
