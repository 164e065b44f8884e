"""plans of the listing analytics engine."""
