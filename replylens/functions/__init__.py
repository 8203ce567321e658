"""Column builders (built-in expressions only; no Python UDFs)."""

from .dates import (coerce_iso_date, combine, date_in_text, normalize_date, resolve_relative,
                    sheet_date, time_text)
from .meta import parse_meta, with_parsed_meta
from .scoring import (score_code, score_from_label, score_label, segment_code, segment_from_label,
                      segment_label)
from .text import (canonical_id, classify_shift, fix_spaces, flag_text, fold_accents, is_valid_title,
                   media_text, norm_name, norm_title, null_if_token, preview, safe_name, strip, yes_flag)
from .times import (coerce_hms, empty_cell, hms_to_seconds, hour_of, normalize_time, seconds_between,
                    seconds_to_hms)

__all__ = [n for n in dir() if not n.startswith("_")]
