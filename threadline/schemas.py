"""Column names and types of the stages."""

MESSAGES = "id long, source_file string, line_no int, ts timestamp_ntz, sent_date string, sent_time string, sender string, text string, media_type string, media_path string, has_media boolean"
MASTER = (
    "sub_id string, conversation_id string, source_file string, start_ts timestamp_ntz, end_ts timestamp_ntz, total_messages long, client_messages long, "
    "admin_messages long, has_media boolean, has_credentials boolean, response string, handling string, category string, predicted string, confidence double, match string, transcript string"
)
#: Columns that reports need.
REPORT_COLUMNS = ("sub_id", "conversation_id", "source_file", "start_ts", "handling", "category")


def missing_columns(columns: list[str], required: tuple[str, ...] = REPORT_COLUMNS) -> list[str]:
    """Required columns that are absent, in order (checked on names, before anything runs)."""
    return sorted(set(required) - set(columns))


def require(columns: list[str], required: tuple[str, ...] = REPORT_COLUMNS) -> None:
    """Raise if a required column is absent."""
    if absent := missing_columns(columns, required):
        raise ValueError(f"missing columns: {', '.join(absent)}")
