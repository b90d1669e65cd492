"""Field, scene and vegetation-index analytics as Spark DataFrame operators."""
