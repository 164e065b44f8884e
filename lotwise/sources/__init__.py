"""sources of the listing analytics engine."""
