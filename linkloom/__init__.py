"""linkloom: the data side of a focused web crawl, as Spark DataFrame jobs."""
