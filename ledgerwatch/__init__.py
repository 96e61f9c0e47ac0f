"""Payment monitoring and anti-money-laundering analytics on stock PySpark."""
