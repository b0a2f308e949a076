"""helioframe: panel time-series preparation, hurdle models and evaluation as Spark jobs."""
