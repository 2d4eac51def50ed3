"""Fixed values that decide which lines count and how they are labelled."""

# Line and request patterns.
CLF_LINE = r'^(\S+)\s+\S+\s+\S+\s+\[([^\]]+)\]\s+"(.*)"\s+(\d{3})\s+(\S+)$'
CLF_REQUEST = r'^(\S+)\s+(\S+)(?:\s+(\S+))?$'
STRICT_DAILY = r'^([^ ]+) [^ ]+ [^ ]+ \[(.*)\] ".*" ([0-9]{3}) ([^ ]+)$'
STRICT_RESOURCES = (
    r'^([^ ]+) [^ ]+ [^ ]+ \[(.*)\] "([^ ]+) ([^ ]+)(?: +[^ ]+)?" ([0-9]{3}) ([^ ]+)$'
)
STRICT_HOURLY = (
    r'^([^ ]+) [^ ]+ [^ ]+ \[([^:]+):([0-9]{2}):[0-9]{2}:[0-9]{2} [^ ]+\] ".*" ([0-9]{3}) [^ ]+$'
)
CLOCK_HOURLY = (
    r'^(\S+)\s+\S+\s+\S+\s+\[(\S+):(\d{2}):\d{2}:\d{2}\s+\S+\]\s+".*"\s+(\d{3})\s+\S+$'
)
NON_PRINTABLE = r'[^\x20-\x7E]'

# Business rules.
METHODS = ("GET", "POST", "HEAD")
ERROR_LOW, ERROR_HIGH = 400, 599
TOP_RESOURCES = 20
CHUNK_LINES = 500_000
HOST_SEPARATOR = "#"
FIELD_SEPARATOR = "_"
REPORT_PATH_WIDTH, REPORT_PATH_KEPT = 48, 45

# Characters removed from both ends of a line: U+0000 to U+0020.
EDGE_CHARACTERS = "".join(map(chr, range(0x21)))

# Field names of each schema-on-read pattern, in group order.
READ_SHAPES = {
    "lenient": (CLF_LINE, ("host", "log_time", "request", "status", "bytes")),
    "strict_daily": (STRICT_DAILY, ("host", "log_time", "status", "bytes")),
    "strict_resources": (
        STRICT_RESOURCES,
        ("host", "log_time", "method", "path", "status", "bytes"),
    ),
    "strict_hourly": (STRICT_HOURLY, ("host", "log_date", "log_hour", "status")),
    "clock_hourly": (CLOCK_HOURLY, ("host", "log_date", "log_hour", "status")),
}
