"""The gates and the first-seen rule on a stream of shards."""
