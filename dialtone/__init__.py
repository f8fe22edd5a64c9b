"""dialtone: Spark-native IVR call analytics and relational model validation.

Sub-packages
------------
sources    typed readers, the IVR schema, driver-table bindings, the DDL model
functions  column expressions (date ids, label classes, cleaners) and SQL functions
operators  DataFrame operators: detail, profile, features, recency, summary,
           cleaning, validation, skew-safe sequencing
plans      end-to-end jobs that build and replace tables
"""

__all__ = ["session"]
