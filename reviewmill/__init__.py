"""Review analytics as lazy Spark DataFrame transformations and Spark ML fits."""
