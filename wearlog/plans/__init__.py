"""The batch run: landing text to bronze, silver and gold tables, and the model."""
