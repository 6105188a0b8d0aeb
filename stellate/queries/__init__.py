"""Every operator and job run over whole tables, each with the same question in plain SQL."""
