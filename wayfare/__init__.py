"""Travel analytics as Spark jobs: quality gate, entity tables, features, models, scoring."""
