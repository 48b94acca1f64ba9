from eventmart.sources.batches import (
    BATCH,
    Spread,
    State,
    Stored,
    commit,
    compact,
    publish,
    read_batches,
    state,
    stored,
    sweep,
    write_batch,
)
from eventmart.sources.files import (
    CORRUPT,
    FILE_NAME,
    FILE_PATH,
    PLACE,
    file_facts,
    found_headers,
    manifest,
    placed,
    read_delimited,
    read_lines,
    read_master,
    stream_lines,
    text_schema,
)
from eventmart.sources.sinks import (
    export_name,
    write_delimited,
    write_table,
)
from eventmart.sources.tables import read_optional, read_table

__all__ = [
    "BATCH",
    "CORRUPT",
    "FILE_NAME",
    "FILE_PATH",
    "PLACE",
    "Spread",
    "State",
    "Stored",
    "commit",
    "compact",
    "export_name",
    "file_facts",
    "found_headers",
    "manifest",
    "placed",
    "publish",
    "read_batches",
    "read_delimited",
    "read_lines",
    "read_master",
    "read_optional",
    "read_table",
    "state",
    "stored",
    "stream_lines",
    "sweep",
    "text_schema",
    "write_batch",
    "write_delimited",
    "write_table",
]
