"""Hashtag and repost analytics expressed as Spark jobs."""
