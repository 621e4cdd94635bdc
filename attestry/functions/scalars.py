"""Scalar functions: money, seasons, white space, URLs, identifiers, timestamps, locators.

White space means what Python's str.isspace() means; patterns are anchored with \\A and \\z, as $ would accept a final
line feed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
#: Texts that stand for no amount, besides N/A in any case.
NO_AMOUNT = ("", "-", "–", "—")
_AMOUNT = r"\A\$?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)\z"
#: RFC 3986, appendix B, with the scheme of section 3.1.
_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
#: A host, as a name or a bracketed address, and a port or none.
_HOST = r"\A(?:\[[0-9A-Fa-f:.]+\]|[^:\[\]@]+)(?::[0-9]*)?\z"
#: Words that locators and names of files may not hold, in any case.
SENSITIVE = ("authorization", "bearer", "cookie", "password", "secret", "session", "token")
#: What can't be printed: characters of the categories C and Z other than the space.
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def strip(value: Column) -> Column:
    return F.regexp_replace(value, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse_whitespace(value: Column) -> Column:
    return strip(F.regexp_replace(value, rf"(?U){SPACE}+", " "))


def canonical_description(value: Column) -> Column:
    """Collapsed text, null if blank. Compose with unicode.nfc for text that is not ASCII."""
    return F.nullif(collapse_whitespace(value), F.lit(""))


def money_digits(value: Column) -> Column:
    """Canonical digits of a money text; null for no amount and for malformed text alike (see money_is_valid). Any length."""
    token = strip(value)
    digits = F.regexp_replace(F.translate(token, "$,", ""), r"\A0+(?=[0-9])", "")
    return F.when(token.rlike(_AMOUNT), digits)


def money_is_valid(value: Column) -> Column:
    token = strip(value)
    return F.coalesce(token.rlike(_AMOUNT) | token.isin(*NO_AMOUNT) | (F.upper(token) == "N/A"), F.lit(False))


def money_amount(value: Column) -> Column:
    """Exact amount of up to 38 digits; a longer one raises rather than becoming null."""
    return money_digits(value).cast("decimal(38,0)")


def season_is_valid(value: Column) -> Column:
    """ASCII yyyy-yy whose second year follows the first; 2099-00 does."""
    shaped = value.rlike(r"\A[0-9]{4}-[0-9]{2}\z")
    return F.coalesce(F.when(shaped, F.pmod(F.substring(value, 3, 2).cast("int") + 1, F.lit(100)) == F.substring(value, 6, 2).cast("int")), F.lit(False))


def season_of(date: Column, first_month: int = 7) -> Column:
    """The season that a date falls in, for seasons that begin in first_month."""
    start = F.year(date) - F.when(F.month(date) < first_month, 1).otherwise(0)
    return F.concat(F.lpad(start.cast("string"), 4, "0"), F.lit("-"), F.lpad(F.pmod(start + 1, F.lit(100)).cast("string"), 2, "0"))


def url_parts(value: Column) -> dict[str, Column]:
    return {name: F.regexp_extract(value, _URL, i) for i, name in enumerate(("scheme", "authority", "path"), start=1)}


def url_is_clean(value: Column) -> Column:
    """Neither empty, nor with white space, control characters, a backslash or a port that isn't one."""
    port = F.regexp_extract(url_parts(value)["authority"], r":([^:\]]*)\z", 1)
    bad = (value == "") | value.rlike(rf"(?U){SPACE}|\p{{C}}|\\") | ((port != "") & (~port.rlike(r"\A[0-9]{1,5}\z") | (port.try_cast("int") > 65535)))
    return F.coalesce(~bad, F.lit(False))


def canonical_url(value: Column) -> Column:
    """Without query and fragment, scheme and authority in lower case, the path as it is."""
    parts = url_parts(value)
    scheme = F.when(parts["scheme"] != "", F.concat(F.lower(parts["scheme"]), F.lit(":"))).otherwise(F.lit(""))
    host = F.when(value.rlike(r"^(?:[^:/?#]+:)?//"), F.concat(F.lit("//"), F.lower(parts["authority"]))).otherwise(F.lit(""))
    return F.concat(scheme, host, parts["path"])


def full_http_url(value: Column) -> Column:
    """canonical_url of a full http(s) URL without user information, else null."""
    parts = url_parts(value)
    good = F.lower(parts["scheme"]).isin("http", "https") & parts["authority"].rlike(_HOST) & url_is_clean(value)
    return F.when(good, canonical_url(value))


def linked_url(value: Column) -> Column:
    """canonical_url of a full http(s) URL, one that begins with // and a host, or a root-relative path; else null."""
    parts = url_parts(value)
    rooted = (parts["scheme"] == "") & value.startswith("/") & F.when(value.startswith("//"), parts["authority"].rlike(_HOST)).otherwise(True)
    good = rooted & url_is_clean(value)
    return F.coalesce(full_http_url(value), F.when(good, canonical_url(value)))


def absolute_image_url(value: Column, base: str) -> Column:
    """absolute_url() if the reference is clean and leads to a public http(s) host, else null."""
    parts = url_parts(value)
    clean = (value != "") & ~value.rlike(rf"(?U){SPACE}|\\") & ((parts["scheme"] == "") | parts["scheme"].isin("http", "https") & parts["authority"].rlike(_HOST)) & ~(value.startswith("//") & ~parts["authority"].rlike(_HOST))
    whole = absolute_url(value, base)
    return F.when(clean & url_parts(whole)["authority"].rlike(_HOST), whole)


def absolute_url(value: Column, base: str) -> Column:
    """A reference joined to the page that it was found on: full, //host, root-relative or relative to the page's folder."""
    scheme, rest = base.split("://", 1)
    host, _, path = rest.partition("/")
    root = f"{scheme}://{host}"
    folder = f"{root}/{path.rpartition('/')[0]}".rstrip("/") + "/"
    said = F.when(value.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), value).when(value.startswith("//"), F.concat(F.lit(f"{scheme}:"), value))
    return said.when(value.startswith("/"), F.concat(F.lit(root), value)).otherwise(F.concat(F.lit(folder), value))


def trailing_id(value: Column) -> Column:
    """Digits of a path's last part, without leading zeros; null without any."""
    found = F.regexp_extract(url_parts(value)["path"], r"/([0-9]+)/?$", 1)
    return F.when(found != "", F.regexp_replace(found, r"\A0+(?=[0-9])", ""))


def image_id(value: Column, folder: str = "logos") -> Column:
    """Digits that name a .png file in a folder; null without any."""
    found = F.regexp_extract(url_parts(value)["path"], rf"/{folder}/([0-9]+)\.png$", 1)
    return F.when(found != "", F.regexp_replace(found, r"\A0+(?=[0-9])", ""))


def unsigned_digits(value: Column) -> Column:
    """Canonical digits of ASCII digits; null for the empty text and for any other."""
    return F.when(value.rlike(r"\A[0-9]+\z"), F.regexp_replace(value, r"\A0+(?=[0-9])", ""))


def is_utc_timestamp(value: Column) -> Column:
    shaped = value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z")
    return F.coalesce(shaped & F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ssX")).isNotNull(), F.lit(False))


def is_safe_basename(value: Column) -> Column:
    """A file's name of lower-case ASCII letters, digits, points and hyphens that doesn't begin with either of these, and holds no sensitive word."""
    return F.coalesce(value.rlike(r"\A[a-z0-9][a-z0-9.-]*\z") & ~_sensitive(value), F.lit(False))


def _sensitive(value: Column) -> Column:
    return value.rlike(f"(?i)(?:{'|'.join(SENSITIVE)})")


def is_safe_locator(value: Column) -> Column:
    """Text without white space at its ends, control characters, sensitive words, absolute paths or file URLs; one with a scheme must be
    http(s) with a host and have neither user information nor a query. A bracket that holds no address makes it unsafe."""
    parts = url_parts(value)
    bad = (value == "") | (value != strip(value)) | value.rlike(r"\p{C}") | _sensitive(value) | value.rlike(r"(?i)\A(?:[/\\~]|[a-z]:[\\/])|file://") | parts["authority"].rlike(r"\[(?![0-9A-Fa-f:.]+\])")
    far = F.lower(parts["scheme"]).isin("http", "https") & parts["authority"].rlike(_HOST) & ~value.rlike(r"\A[^?#]*\?[^#]")
    return F.coalesce(~bad & ((parts["scheme"] == "") | far), F.lit(False))


def printable(value: Column, most: int = 80) -> Column:
    """The text's beginning with a question mark for what can't be printed, for messages."""
    return F.substring(F.regexp_replace(value, UNPRINTABLE, "?"), 1, most)


def paginator(value: Column) -> dict[str, Column]:
    """N and M of a text `N of M` with 1 <= N <= M, else nulls."""
    shape = r"\A\s*([0-9]{1,9})\s+of\s+([0-9]{1,9})\s*\z"
    n, m = (F.nullif(F.regexp_extract(value, shape, i), F.lit("")).cast("int") for i in (1, 2))
    good = (n >= 1) & (n <= m)
    return {"page": F.when(good, n), "pages": F.when(good, m)}
