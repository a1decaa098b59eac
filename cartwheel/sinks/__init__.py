"""Writers: files, idempotent batch sinks, snapshots, Kafka."""
