"""New landed files as a stream that stops when it has caught up."""
