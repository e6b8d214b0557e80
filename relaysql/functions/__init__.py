"""Functions callable from job SQL: SQL-bodied library, registration, lookups."""
