"""Named queries and the end-to-end remodelling run."""
