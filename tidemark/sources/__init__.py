"""Reading landed data into canonical tables, and keyed writes."""
