"""Keys: URLs in one form, uids and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from admitta.functions.text import EDGES, match_form, slug

#: Query keys that begin like this are tracking keys.
TRACKING = ("utm_", "fbclid", "gclid", "ref")


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, default ports, tracking and blank keys, fragment and last slash left out; keys sorted.

    Ports are left out only where they are whole (``:8080`` stays). A text without scheme gets https.
    """
    url = F.trim(c)
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    before = F.regexp_replace(rest, r"\?.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(before, r"^([^/]*)", 1)), r":(80|443)$", "")
    path = F.rtrim(F.regexp_replace(F.regexp_extract(before, r"^[^/]*(/.*)?$", 1), r";[^/]*$", ""), F.lit("/"))
    tracked = r"^(" + "|".join(TRACKING) + ")"
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]+=.+$") & ~p.rlike(tracked))
    kept = F.array_join(F.array_sort(pairs), "&")
    return F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def uid(c: Column) -> Column:
    """N7."""
    return F.sha2(c, 256)


def content_hash(c: Column) -> Column:
    """Hash of the text with plain line ends and without blanks around it; null gives an empty text."""
    return F.when(c.isNull(), "").otherwise(F.sha2(F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), EDGES, ""), 256))


def faculty_uid(faculty_slug: Column) -> Column:
    return uid(F.concat(F.lit("faculty:"), faculty_slug))


def program_uid(url: Column, name: Column) -> Column:
    return uid(F.concat(url, F.lit("|"), slug(name)))


def program_id(faculty_slug: Column, name: Column) -> Column:
    return uid(F.concat(faculty_slug, F.lit("|"), match_form(name)))


def snapshot_name(at: Column, key: Column) -> Column:
    return F.concat(F.date_format(at, "HHmmss"), F.lit("_"), F.left(key, F.lit(8)), F.lit("_snapshot.html"))


def pdf_name(url: Column, prefix: str) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.left(F.md5(url), F.lit(8)), F.lit(".pdf"))


def host(c: Column) -> Column:
    """P20."""
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def subdomain(c: Column, domain: str = "example") -> Column:
    """What stands before the domain of the university; ``unknown`` without it."""
    found = F.regexp_extract(c, rf"https?://([^./]+)\.(?:[^/]+\.)?{domain}\b", 1)
    return F.when(found == "", "unknown").otherwise(found)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute link from the page's address. Dot segments are left to the server."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]*)$", "$1/")
    folder = F.regexp_replace(folder, r"[^/]*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, href))
    )


def admission_year(url: Column, text: Column, default: int | None) -> Column:
    """P10: the first year of the 2020s in the URL, else in the text, else the default."""
    found = [F.nullif(F.regexp_extract(c, r"202[0-9]", 0), F.lit("")).cast("int") for c in (url, text)]
    return F.coalesce(*found, F.lit(default).cast("int"))
