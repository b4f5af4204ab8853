"""URL cleaning, parsing and pattern text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_url(url: Column) -> Column:
    """Trimmed, without double quotes, trailing ``*`` and one trailing ``/``."""
    out = F.regexp_replace(F.trim(url), r'"|\*$', "")
    return F.regexp_replace(out, "/$", "")


def protocol(url: Column) -> Column:
    return F.regexp_extract(url, "^(https|http)", 1)


def with_protocol(url: Column) -> Column:
    """The URL itself, or with ``http://`` in front when it names no protocol."""
    return F.when(protocol(url) != "", url).otherwise(F.concat(F.lit("http://"), url))


def url_parts(url: Column) -> dict[str, Column]:
    """host, file (path and query), path and query of an already cleaned URL; null where absent."""
    full = with_protocol(url)

    def part(name: str) -> Column:
        return F.try_parse_url(full, F.lit(name))

    return {
        "host": F.regexp_replace(part("HOST"), r"^\*|^\.|\*$|\.$", ""),
        "file": F.regexp_replace(part("FILE"), r"^/\*", "/"),
        "path": F.regexp_replace(part("PATH"), r"^/\*", "/"),
        "query": F.regexp_replace(part("QUERY"), r"^\*|\*$", ""),
    }


def matcher_pattern(url_regexp: Column, host: Column, path: Column, url_key: Column) -> Column:
    """The whole pattern without a key, else ``host + path|key``."""
    return F.when(url_key == "", url_regexp).otherwise(
        F.concat(host, path, F.lit("|"), url_key)
    )


def screen_pattern(root_domain: Column, host: Column, protocol_type: Column, path: Column) -> Column:
    """``root~host~~~path~1``; the path is left out under https."""
    return F.concat_ws(
        "~",
        root_domain,
        host,
        F.lit(""),
        F.lit(""),
        F.when(protocol_type == "https", F.lit("")).otherwise(path),
        F.lit("1"),
    )
