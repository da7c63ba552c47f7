"""churnwise: customer-retention analytics as Spark DataFrame operators.

Every operator takes a DataFrame (plus keyword parameters) and returns a
DataFrame built from Spark SQL expressions, so Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
