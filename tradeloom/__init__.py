"""Commerce order insights as Spark DataFrame jobs."""
