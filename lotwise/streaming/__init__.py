"""streaming of the listing analytics engine."""
