"""Access-log analytics on Spark: parse Common Log Format text once, answer
daily-traffic, top-resource and hourly-error questions over any number of
batches, and keep results, run metadata and data-quality counts."""
