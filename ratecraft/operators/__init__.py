"""DataFrame-in / DataFrame-out operators of the scoring application."""
