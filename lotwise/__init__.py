"""lotwise: listing analytics and data preparation as lazy PySpark plans."""
