"""Files and tables: raw CSV, the processed zone, catalog tables."""
