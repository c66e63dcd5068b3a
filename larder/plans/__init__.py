"""Named queries, their SQL counterparts, and the layered pipeline."""
