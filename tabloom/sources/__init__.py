"""Sources and sinks: delimited text with null tokens, run log, model store."""
