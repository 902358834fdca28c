"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def authority(url: Column) -> Column:
    """Host and port; a URL without one gives an empty string."""
    return F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    """The path without parameters, query and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*\z", ""), r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    return F.regexp_replace(bare, r";[^/]*\z", "")


def without_www(host: Column) -> Column:
    """Every ``www.`` goes, wherever it stands."""
    return F.replace(host, F.lit("www."), F.lit(""))


def same_domain(url: Column, other: Column) -> Column:
    return without_www(authority(url)) == without_www(authority(other))


def canonical(url: Column) -> Column:
    """Scheme, authority, path and query: no fragment, no parameters of the last segment."""
    query = F.regexp_extract(url, r"\?([^#]+)", 1)
    scheme = F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    return F.concat(scheme, F.lit("://"), authority(url), path(url), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def file_name(url: Column) -> Column:
    """Domain and path of a URL as one Markdown file name; query and fragment don't count."""
    trimmed = F.regexp_replace(path(url), r"\A/+|/+\z", "")
    domain = without_www(authority(url))
    return F.when(trimmed == "", F.concat(domain, F.lit(".md"))).otherwise(F.concat(domain, F.lit("_"), F.replace(trimmed, F.lit("/"), F.lit("_")), F.lit(".md")))


def domain_of(url: Column) -> Column:
    """The domain as cleaning rules name it: scheme, path and every ``www.`` removed."""
    bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return without_www(F.substring_index(bare, "/", 1))
