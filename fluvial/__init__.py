"""fluvial: river-network analytics expressed as Spark DataFrame plans."""
