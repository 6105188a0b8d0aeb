"""Raw business tables to a clean layer, and the clean layer to a star schema, on Spark."""
