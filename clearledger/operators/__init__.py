"""DataFrame -> DataFrame operators: checks, profiles, outliers, identifiers, relationships,
quality reports and chart extracts."""
