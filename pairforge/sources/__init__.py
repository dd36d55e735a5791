"""Sources and sinks: parquet / catalog tables, typed JSONL, stage hand-off, derived test inputs."""
