"""Reading playlists, guides, dictionaries and registries; writing playlists, guides and summaries."""
