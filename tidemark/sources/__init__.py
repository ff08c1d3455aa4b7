"""File sources and sinks, feeds, and structured data in pages."""
