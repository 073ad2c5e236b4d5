"""Landing files, stored tables and the derived legacy views."""
