"""Input tables derived from the star schema, registered queries and their SQL."""
