"""Column expressions: Column in, Column out, all inside whole-stage codegen."""

from tierkit.functions.geo import haversine_distance
from tierkit.functions.keys import surrogate_key
from tierkit.functions.numeric import safe_add, safe_divide, safe_subtract, width_bucket
from tierkit.functions.text import blank_to_null, slugify, squeeze_spaces
from tierkit.functions.web import url_host, url_parameter, url_path

__all__ = [
    "blank_to_null",
    "haversine_distance",
    "safe_add",
    "safe_divide",
    "safe_subtract",
    "slugify",
    "squeeze_spaces",
    "surrogate_key",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]
