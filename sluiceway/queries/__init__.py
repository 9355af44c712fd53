"""Every operator and job run over the given tables, with the SQL that checks it."""
