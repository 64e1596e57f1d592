"""The scoring application expressed as Spark plans."""
