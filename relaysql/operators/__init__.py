"""Schema parsing, message decode and result shaping: column expressions only."""
