"""Writers: idempotent date loads, snapshot upserts, chunked exports, logs and JDBC."""
