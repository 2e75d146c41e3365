from feedwell.functions.cells import NA_WORDS, missing_to_null, non_blank
from feedwell.functions.names import ascii_key, ascii_marker, key_of, key_text, marker_of, marker_text
from feedwell.functions.paths import basename, minute_stamp

__all__ = [
    "NA_WORDS", "ascii_key", "ascii_marker", "basename", "key_of", "key_text", "marker_of", "marker_text",
    "minute_stamp", "missing_to_null", "non_blank",
]
