"""Tables kept current by a stream of arriving files."""
