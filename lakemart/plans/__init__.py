"""End-to-end plans: the medallion refresh and the propensity run."""
