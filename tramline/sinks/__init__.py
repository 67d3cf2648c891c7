"""Writers: stored tables, topics, logs, snapshots and exports."""
