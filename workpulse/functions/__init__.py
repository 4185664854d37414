from workpulse.functions.expr import (  # noqa: F401
    any_match, blank_to_null, bucketize, c, chronology_violation, decode_flag,
    epoch_seconds, full_name, invalid_identifier, malformed_numeric, minutes_between,
    pct, prettify_enum, rnd, strip_prefix,
)
