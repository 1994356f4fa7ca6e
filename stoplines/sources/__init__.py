"""Reading the feed archives and the station list; reading and writing tables."""
