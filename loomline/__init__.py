"""Training-text preparation, run-log tables and chat-log tables as Spark jobs."""
