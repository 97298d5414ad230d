"""Sources and sinks: file readers, driver-table adapters, telemetry, publishing."""
