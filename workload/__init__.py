"""Every operator run over the given test tables, with SQL to check it against."""
