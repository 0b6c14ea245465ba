"""Retail sales lakehouse operators on PySpark.

Every operator is a function from DataFrame to DataFrame: it declares a plan and
triggers no action.  Jobs in ``tillwise.plans`` chain operators and write tables.
"""

__version__ = "0.1.0"
