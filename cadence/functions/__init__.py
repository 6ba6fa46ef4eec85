from cadence.functions.text import (  # noqa: F401
    GENRE_KEYWORDS, URI_PREFIXES, display_label, epoch_date, has_prefix,
    keyword_label, match_key, normalize_title, seed_context, uri_of,
)
