"""Clinical data warehouse on Spark: dated drops -> lake -> bronze -> silver -> gold KPIs."""
