"""Sources and sinks: supplied tables, panel adapters, forecast/metric files."""
