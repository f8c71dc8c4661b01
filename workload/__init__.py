"""The registered queries on the star-schema test tables, and their SQL counterparts."""
