"""Document-evidence analytics expressed as Spark plans."""
