"""Registered queries, the SQL that checks them, and plan inspection."""
