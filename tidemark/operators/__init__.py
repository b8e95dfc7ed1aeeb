"""Landing, syncing, snapshots, profiling and reconciliation."""
