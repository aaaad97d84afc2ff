"""Business pipelines composed from the operators; domain constants live here."""
