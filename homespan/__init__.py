"""homespan: property-valuation analytics as Spark DataFrame operators."""
