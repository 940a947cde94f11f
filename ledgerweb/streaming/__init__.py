"""The same features and scores over a stream."""
