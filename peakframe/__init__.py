"""Event-selection and mass-spectrum analytics on Spark DataFrames."""
