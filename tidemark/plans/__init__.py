"""The registered queries, each beside the SQL that it equals."""
