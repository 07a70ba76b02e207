"""Record feeds derived from the test tables, and table readers."""
