"""sluicegate: event filtering, batching and acknowledgement on Spark, and corpus operators."""
