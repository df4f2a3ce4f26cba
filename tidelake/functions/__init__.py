from tidelake.functions.scalars import (  # noqa: F401
    bucket_label,
    file_date,
    file_hour,
    has_id,
    hour_of,
    is_bot,
    json_long,
    json_string,
    naive_utc,
    as_naive_utc,
    or_zero,
    parse_ts,
    repo_owner,
    watch_action,
)
