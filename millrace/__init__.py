"""Legacy retail cleansing, quarantine, publication and validation as Spark jobs."""
