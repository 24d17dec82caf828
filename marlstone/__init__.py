"""Marlstone: analytics over model-development data as composable Spark DataFrame code."""
