"""Sources and sinks: file inventory, typed landing loads, load log, partitioned batch tables."""
