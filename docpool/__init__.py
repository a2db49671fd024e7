"""docpool: curation of pools of interleaved text-and-image records on Spark."""
