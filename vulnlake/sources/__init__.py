"""Reading the feed and the cleaned layer, writing layers, and catalog tables."""
