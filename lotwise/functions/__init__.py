"""functions of the listing analytics engine."""
