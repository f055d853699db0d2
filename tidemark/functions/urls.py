"""URL parts as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Schemes that are stripped before the host is read.
HOST_SCHEMES = ("android-app://", "http://", "https://")


def _without_scheme(url: Column) -> Column:
    pattern = "|".join(re.escape(s) for s in HOST_SCHEMES)
    return F.regexp_replace(url, pattern, "")


def url_host(url: Column) -> Column:
    """Text between the scheme and the first slash or question mark."""
    return F.regexp_extract(_without_scheme(url), r"^([^/?]*)", 1)


def url_path(url: Column) -> Column:
    """Text after the host's slash up to the query string, without the leading slash."""
    return F.regexp_extract(_without_scheme(url), r"^[^/?]*/?([^?]*)", 1)


def url_parameter(url: Column, name: str) -> Column:
    """Value of one query parameter, null when absent or empty."""
    found = F.regexp_extract(url, f"{re.escape(name)}=([^&]*)", 1)
    return F.when(found != "", found)
