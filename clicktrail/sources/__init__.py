"""Reading the inputs, writing the reports."""
