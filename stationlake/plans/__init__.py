"""End-to-end plans: silver tables, the gold star schema, SQL reports, batch runner."""
