"""Carbon-footprint analytics on Spark: trips and purchases in, kg CO2e out."""
