"""quern: five batch text and rating analyses written as Spark DataFrame jobs."""
