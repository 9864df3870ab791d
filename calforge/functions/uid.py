"""Name-based UUID (RFC 4122 version 5, SHA-1) as a native expression.

uuid5(ns, name) = first 16 bytes of sha1(ns_bytes || utf8(name)) with the version
nibble set to 5 and the variant bits set to 10xx. On the 40-hex-digit SHA-1 text that
is: digit 13 -> '5', digit 17 -> one of 8,9,a,b (keep its low two bits).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RFC 4122 URL namespace and the calendar UID domain suffix.
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"
UID_DOMAIN = "bs-events.de"

_VARIANT_FROM = "0123456789abcdef"
_VARIANT_TO = "89ab89ab89ab89ab"


def uuid5_url(name_col: Column) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), F.encode(name_col, "UTF-8")))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        F.translate(F.substring(h, 17, 1), _VARIANT_FROM, _VARIANT_TO), F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def uuid5_url_sql(name_expr: str) -> str:
    h = f"sha1(unhex('{NAMESPACE_URL_HEX}') || encode({name_expr}))"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"translate(substr({h}, 17, 1), '{_VARIANT_FROM}', '{_VARIANT_TO}') || substr({h}, 18, 3) || '-' || "
            f"substr({h}, 21, 12))")


def event_uid(title_col: Column, date_col: Column, domain: str = UID_DOMAIN) -> Column:
    """``uuid5(URL, title + '-' + date) + '@' + domain`` on the escaped, unstripped title."""
    return F.concat(uuid5_url(F.concat(title_col, F.lit("-"), date_col)), F.lit("@" + domain))


def event_uid_sql(title_expr: str, date_expr: str, domain: str = UID_DOMAIN) -> str:
    return f"({uuid5_url_sql(f'({title_expr} || {chr(39)}-{chr(39)} || {date_expr})')} || '@{domain}')"
