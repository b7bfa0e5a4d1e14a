"""User-agent parsing: rule columns for the old models, one parse per distinct text for the new ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .arith import col

# Marker in the text, family name. The first marker found wins.
BROWSER_MARKERS = [
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("Android", "Android"),
    ("Electron/", "Electron"),
    ("Edge/", "Edge"),
    ("Edg/", "Edge"),
    ("MSIE", "IE"),
    ("Trident/", "IE"),
    ("Firefox/", "Firefox"),
    ("Chrome/", "Chrome"),
    ("Safari/", "Safari"),
]
OS_MARKERS = [
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("CrOS", "Chrome OS"),
    ("Android", "Android"),
    ("Macintosh", "Mac"),
    ("Windows", "Windows"),
    ("Linux", "Linux"),
]
# Marker that selects the rule, text in front of the version number.
BROWSER_VERSION_AFTER = [
    ("Edge/", "Edge/"),
    ("Edg/", "Edg/"),
    ("Trident/", "Trident/"),
    ("Chrome/", "Chrome/"),
    ("Firefox/", "Firefox/"),
    ("Safari/", "Version/"),
]
# Marker that selects the rule, text in front of the version, text that ends it.
OS_VERSION_BETWEEN = [
    ("iPhone", "iPhone OS ", " "),
    ("iPad", "CPU OS ", " "),
    ("CrOS", "CrOS ", ")"),
    ("Android", "Android ", ";"),
    ("Macintosh", "Mac OS X ", ")"),
    ("Windows", "Windows ", ")"),
    ("Linux", "Linux ", ")"),
]


def _first(pairs: list[tuple[Column, Column]], otherwise: str) -> Column:
    out = None
    for test, value in pairs:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(F.lit(otherwise))


def browser(c: Column | str) -> Column:
    return _first([(F.contains(col(c), F.lit(m)), F.lit(name)) for m, name in BROWSER_MARKERS], "Other")


def operating_system(c: Column | str) -> Column:
    return _first([(F.contains(col(c), F.lit(m)), F.lit(name)) for m, name in OS_MARKERS], "Other")


def _between(c: Column, start: str, end: str) -> Column:
    tail = F.split_part(c, F.lit(start), F.lit(2))
    return F.split_part(tail, F.lit(end), F.lit(1))


def browser_version(c: Column | str, app_marker: str = "Desktop/") -> Column:
    """Version text after the browser marker; desktop clients carry their own app marker."""
    rules = [("Electron/", app_marker), *BROWSER_VERSION_AFTER]
    return _first([(F.contains(col(c), F.lit(m)), _between(col(c), before, " ")) for m, before in rules], "Other")


def os_version(c: Column | str) -> Column:
    pairs = []
    for marker, start, end in OS_VERSION_BETWEEN:
        value = _between(col(c), start, end)
        if marker == "Windows":
            value = F.split_part(value, F.lit(";"), F.lit(1))
        if marker == "CrOS":
            value = F.split_part(value, F.lit("CS"), F.lit(1))
        pairs.append((F.contains(col(c), F.lit(marker)), value))
    return _first(pairs, "Unknown")


def event_client(source: Column | str, agent: Column | str, web_sources: Sequence[str] = ("WEBAPP_EVENTS",), mobile_sources: Sequence[str] = ("MOBILE_EVENTS",)) -> Column:
    """Client type of an event from the relation it came from (upper-case names) and its user agent."""
    web = F.upper(col(source)).isin(*web_sources)
    electron = F.contains(F.lower(col(agent)), F.lit("electron"))
    return (
        F.when(web & electron, "Desktop")
        .when(web & ~electron, "WebApp")
        .when(F.upper(col(source)).isin(*mobile_sources), "Mobile")
        .when(F.upper(col(source)) == "PORTAL_EVENTS", "Customer Portal")
        .otherwise("WebApp")
    )


def client_type(browser_family: Column | str) -> Column:
    family = F.lower(col(browser_family))
    return F.when(family == "electron", "IS_DESKTOP").when(family != "electron", "IS_WEBAPP")


def parse_agents(df: DataFrame, column: str) -> DataFrame:
    """Distinct agent texts with parsed browser and operating system parts."""
    text = F.col(column)
    version = F.regexp_extract(text, r"(?:Electron|Edge|Edg|Firefox|Chrome|Version)/([0-9.]+)", 1)
    os_text = os_version(text)
    return (
        df.select(column)
        .where(text.isNotNull())
        .distinct()
        .select(
            column,
            browser(text).alias("browser_family"),
            F.nullif(F.split_part(version, F.lit("."), F.lit(1)), F.lit("")).alias("browser_version_major"),
            operating_system(text).alias("os_family"),
            F.nullif(os_text, F.lit("")).alias("os_version"),
        )
    )


def enrich_user_agents(df: DataFrame, column: str, registry: DataFrame | None = None) -> DataFrame:
    """Join parsed agents back; each distinct text is parsed once, or read from ``registry``.

    The parsed side is only broadcast when Catalyst sees that it is small.
    """
    parsed = parse_agents(df, column) if registry is None else registry
    return df.join(parsed, column, "left")
