"""Order, purchase and inventory reconciliation as PySpark jobs."""
