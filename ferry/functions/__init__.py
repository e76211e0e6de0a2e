from ferry.functions.keys import domain_label, email_match_key, fold_label
from ferry.functions.predicates import absent, present
from ferry.functions.text import (
    base64_unbroken,
    file_name_of,
    iso_millis,
    keyed_file_name,
    keyed_name_key,
    keyed_name_rest,
    path_safe,
    run_id,
    scrub_line_breaks,
    strip_extension,
    utc_millis_stamp,
)

__all__ = [
    "absent", "base64_unbroken", "domain_label", "email_match_key", "file_name_of", "fold_label",
    "iso_millis", "keyed_file_name", "keyed_name_key", "keyed_name_rest", "path_safe",
    "present", "run_id", "scrub_line_breaks", "strip_extension", "utc_millis_stamp",
]
