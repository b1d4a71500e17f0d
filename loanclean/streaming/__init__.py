"""Row-local work on growing input."""
