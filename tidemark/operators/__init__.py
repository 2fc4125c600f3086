"""DataFrame-to-DataFrame operators on bars and daily series."""
