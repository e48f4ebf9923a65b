"""Analytics warehouse for workspace bookings, built from PySpark DataFrame jobs."""
