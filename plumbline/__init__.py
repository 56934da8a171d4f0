"""plumbline: rule-driven data-quality assessment of entity-attribute-value data on PySpark."""
