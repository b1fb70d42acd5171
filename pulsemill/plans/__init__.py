"""Named pipelines, configuration and the query catalogue."""
