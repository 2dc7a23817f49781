from millrace.sources.archives import (
    member_events,
    members,
    read_archived_events,
    read_archives_once,
    read_archives,
    read_unreadable_archives,
    unreadable_archives,
    unzip,
)
from millrace.sources.intervals import (
    gaps,
    landed_deliveries,
    manifest,
    manifest_between,
    misnamed_files,
    slot_of,
)
from millrace.sources.readers import parse_json, read_edits, read_events, read_table, rescued_fields
from millrace.sources.replay import first_events
from millrace.sources.sinks import (
    publish_table,
    start_payload_batches,
    write_json_batches,
    write_members,
    write_payload_batches,
)
from millrace.sources.sse import (
    parse_sse,
    read_lines,
    read_sse,
    read_sse_once,
    read_unreadable_payloads,
    readable,
    sse_payloads,
    unreadable,
)

__all__ = [
    "first_events",
    "gaps",
    "landed_deliveries",
    "manifest",
    "manifest_between",
    "member_events",
    "members",
    "misnamed_files",
    "parse_json",
    "parse_sse",
    "publish_table",
    "read_archived_events",
    "read_archives_once",
    "read_archives",
    "read_edits",
    "read_events",
    "read_lines",
    "read_sse",
    "read_sse_once",
    "read_table",
    "read_unreadable_archives",
    "read_unreadable_payloads",
    "readable",
    "rescued_fields",
    "slot_of",
    "sse_payloads",
    "start_payload_batches",
    "unreadable",
    "unreadable_archives",
    "unzip",
    "write_json_batches",
    "write_members",
    "write_payload_batches",
]
