"""Remaining-useful-life analytics on panel sensor data, expressed as Spark plans."""
