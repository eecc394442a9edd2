"""lakemart: a Spark-native retail sales lakehouse.

Raw order lines → bronze (as ingested, with lineage) → silver (de-duplicated,
cleaned, typed, guarded by named quality rules; one fact and four dimensions)
→ gold KPI marts; and, on top, customer features at any number of cutoffs,
purchase labels, an MLlib gradient-boosted propensity model, and scoring,
deciles, bands and ranking of every customer. Every step is a DataFrame to
DataFrame function.
"""

__version__ = "0.1.0"
