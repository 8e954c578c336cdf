"""Named reports over the finished tables."""
