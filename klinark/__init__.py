"""Health analytics warehouse written as Spark DataFrame transformations."""
