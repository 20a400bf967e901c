"""Sources and sinks: the feature panel (panel) and file readers/writers (io)."""
