"""Reading tables and delimited files, writing tables, and describing a catalogue."""
