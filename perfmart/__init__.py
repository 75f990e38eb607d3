"""perfmart: a PySpark engine for periodic performance-reporting tables.

Every step is a ``DataFrame -> DataFrame`` function on Spark built-ins;
business rules are data (``perfmart.config``).
"""

__version__ = "0.1.0"
