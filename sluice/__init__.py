"""sluice: config-driven ingestion on Spark DataFrames.

Every operator is a DataFrame -> DataFrame transformation built from Spark
column expressions, so Catalyst plans it and it runs wherever Spark runs.
Records carry an ``_error`` column: NULL means good, text is the reason a
record goes to the dead-letter store.
"""

from sluice.operators.delimited import drop_header_trailer, parse_delimited
from sluice.operators.documents import document_to_row
from sluice.operators.messages_json import bind_json_messages
from sluice.operators.messages_xml import archive_lines, bind_xml_messages
from sluice.operators.results import ERROR_COL, RAW_COL, SRC_COL, bad_rows, good_rows
from sluice.operators.rules import apply_rules, derive_field
from sluice.plans.jobs import avro_batch, csv_batch, run
from sluice.sinks.table import write_table, write_text, write_topic
from sluice.sources.avro import read_avro
from sluice.sources.files import read_dated_lines, read_lines
from sluice.sources.messages import read_message_stream, read_messages
from sluice.sources.sql import sql_source
from sluice.streaming.stream import process_batch, start_message_stream

__all__ = [
    "ERROR_COL", "RAW_COL", "SRC_COL",
    "apply_rules", "archive_lines", "avro_batch", "bad_rows", "bind_json_messages", "bind_xml_messages",
    "csv_batch", "derive_field", "document_to_row", "drop_header_trailer", "good_rows", "parse_delimited",
    "process_batch", "read_avro", "read_dated_lines", "read_lines", "read_message_stream", "read_messages",
    "run", "sql_source", "start_message_stream", "write_table", "write_text", "write_topic",
]
