"""cubeshelf: a Spark-native warehouse of many independent statistical datasets.

Every step (catalog flattening, update planning, CSV conversion, publishing,
catalog refresh, table registration, ad-hoc SQL) is a DataFrame operator that
runs on Spark; the driver only submits jobs and issues catalog DDL.
"""

__version__ = "0.1.0"
