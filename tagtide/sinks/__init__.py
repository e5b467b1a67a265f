"""Tables, topics and markers to write to."""
