"""Writers: one pass over all months, each month replaced as a whole."""
