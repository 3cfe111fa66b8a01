"""Every operator as a query over the order tables, with the SQL that checks it."""
