"""DataFrame -> DataFrame operators (events, sessions, islands, quality, curation)."""
