"""The silver-layer rule sets of the three review sources.

FIXED VALUES: the columns, rule kinds and regular expressions below must be
exactly these for results to agree; the order inside each list is the order
of names in ``failed_columns``.
"""

from __future__ import annotations

from .rules import Rule, cast_regex, not_null, regex

# --- fixed values: silver review rules (source -> ordered rules) -------------
SILVER_RULES: dict[str, list[Rule]] = {
    "google_play": [
        regex("id", r"^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$"),
        regex("app", r"^[a-z0-9\-_]+$"),
        cast_regex("rating", r"^[1-5](\.\d+)?$"),
        regex("iso_date", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
        regex("title", r"^.+$"),
        regex("snippet", r"^.+$"),
    ],
    "mongodb": [
        regex("id", r"^[a-f0-9]+$"),
        not_null("customer_id"),
        regex("cpf", r"^\d{11}$|^\d{3}\.\d{3}\.\d{3}-\d{2}$"),
        regex("app", r"^[a-z0-9\-_]+$"),
        cast_regex("rating", r"^[0-5](\.\d+)?$"),
        regex("timestamp", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?$"),
        not_null("comment"),
        regex("app_version", r"^\d+(\.\d+)*$"),
        regex("os_version", r"^\d+(\.\d+)*$"),
        not_null("os"),
    ],
    "apple_store": [
        regex("id", r"^\d+$"),
        regex("name_client", r"^.+$"),
        regex("app", r"^[a-z0-9\-_]+$"),
        regex("im_version", r"^\d+(\.\d+)*$"),
        cast_regex("im_rating", r"^[0-5](\.\d+)?$"),
        regex("title", r"^.+$"),
        not_null("content"),
    ],
}
# --- end fixed values ---------------------------------------------------------


def rules_for(source: str, layer: str = "silver") -> list[Rule]:
    """Rules of one source. Only the silver layer carries pattern rules."""
    if layer != "silver":
        return []
    try:
        return list(SILVER_RULES[source])
    except KeyError:
        raise ValueError(f"no pattern rules for source {source!r}") from None
