"""stockyard: retail lakehouse jobs (bronze -> silver -> gold, inventory and
demand forecast) written as plain PySpark DataFrame functions.

Every operator is a ``DataFrame -> DataFrame`` function keyed so that it runs
in parallel over many SKUs / orders; nothing passes whole through the driver.
"""

__version__ = "0.1.0"
