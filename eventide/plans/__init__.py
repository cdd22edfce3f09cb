"""Plan building blocks (bucketed prefix scans) and the query catalogue."""
