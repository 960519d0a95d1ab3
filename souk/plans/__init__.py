"""The named queries over the test tables and their independent oracle SQL."""
