"""Jobs composed of operators and Spark ML estimators."""
