"""Reading panels and templates, writing results, keeping tables and models."""
