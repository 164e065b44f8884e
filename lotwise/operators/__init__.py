"""operators of the listing analytics engine."""
