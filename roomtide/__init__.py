"""Hotel booking analytics as lazy DataFrame-to-DataFrame functions on Spark."""
