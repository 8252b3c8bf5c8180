"""Query catalogue: operators of the library applied to whole tables, with their SQL."""
