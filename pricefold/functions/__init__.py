"""Column-expression functions (JVM-side) used by the operators."""

from .cleaning import (blank_to_null, category_fallback, clean_name, map_availability,  # noqa: F401
                       map_availability_negation_first, normalize_category, parse_price_clean)
from .prices import (cost_per_product, parse_price_api, parse_price_locale,  # noqa: F401
                     price_from_snippet, token_cost)
from .text import (availability_from_price, coverage_filter, dedupe_tokens, display_name,  # noqa: F401
                   domain_filter, encoder_text, fuzzy_normalize, is_accessory, is_blocked_page,
                   relevance_window, run_status, sanitize_frame, search_url, strip_spec_noise,
                   strip_title_suffix, token_signature)
