"""File sources and table sinks."""
