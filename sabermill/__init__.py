"""Season analytics as Spark DataFrame jobs: landing, staging, models, boards and checks."""
