"""Plain SQL for another engine, used to check the Spark results. Not part of the library."""
