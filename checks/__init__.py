"""The registered queries with their SQL counterparts, and the log data both are run on."""
