"""Market analytics over repeatedly observed postings, as Spark DataFrame operators."""
