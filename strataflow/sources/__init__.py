"""Sources and sinks: JSON ingestion with quarantine, partitioned table IO,
audit logs, and adapters that shape the benchmark tables as source entities."""
