"""DataFrame operators: matching, selection, splitting, probing, guides, quality and health."""
