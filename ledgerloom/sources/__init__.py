"""Reading tables and reports; writing months, tables and small exports."""
