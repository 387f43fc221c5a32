from tallymark.streaming.ledger import GOOD_AND_BAD, ingest_to_sinks, read_sink
from tallymark.streaming.ndjson import (
    CORRUPT,
    ingest_ndjson,
    parse_ndjson,
    read_ndjson_socket,
    read_ndjson_stream,
    to_ndjson,
)

__all__ = [
    "CORRUPT",
    "GOOD_AND_BAD",
    "ingest_ndjson",
    "ingest_to_sinks",
    "parse_ndjson",
    "read_ndjson_socket",
    "read_ndjson_stream",
    "read_sink",
    "to_ndjson",
]
