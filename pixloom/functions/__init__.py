"""Part of pixloom."""
