"""Log intake on Spark: escaped lines in, clean syslog tables out."""
