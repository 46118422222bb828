"""Grant and contract accounting on Spark: composable ``DataFrame -> DataFrame`` steps."""
