"""Job plans: the batch job, Spark SQL twins of the reports, plan inspection."""
