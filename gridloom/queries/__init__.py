"""Queries of the raster engine over the star schema, each with the SQL that says the same where SQL can."""
