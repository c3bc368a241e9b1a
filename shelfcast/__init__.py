"""Weekly consumer-goods demand analytics expressed as Spark DataFrame jobs."""
