"""Market analytics and text-corpus operators written as Spark DataFrame plans."""
