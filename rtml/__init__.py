"""Real-time and batch machine-learning analytics as composable Spark DataFrame functions."""
