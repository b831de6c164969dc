"""Reading zone files; writing result tables, run snapshots, history and logs."""
