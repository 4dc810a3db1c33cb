"""URL columns: host allow-list, joining, HTML attribute access."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import cache, reduce
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackroom.fixed_values import MEDIA_EXTENSIONS
from stackroom.functions.numbers import let

REFERENCE = r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,40});"
# Small maps that the names of character references are spread over.
NAME_BUCKETS = 1024
HTTPS_HOST = r"^(?i:https)://(?:[^/?#@]*@)?([^/:?#]+)"


def https_host(url: Column) -> Column:
    """Lower-case host without trailing dots; null unless the URL is https with a host."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), HTTPS_HOST, 1)), r"\.+$", ""), F.lit(""))


def host_allowed(url: Column, domains: Iterable[str]) -> Column:
    """Host equals or lies under an allowed domain; null when the URL is not usable."""
    names = sorted({d.rstrip(".").lower() for d in domains})

    def under(host: Column) -> Column:
        tests = [(host == d) | F.endswith(host, F.lit("." + d)) for d in names]
        return F.when(host.isNotNull(), reduce(lambda a, b: a | b, tests, F.lit(False)))

    return let(https_host(url), under)


def has_media_extension(path: Column) -> Column:
    return path.rlike(rf"(?i)(?:{'|'.join(x.replace('.', '[.]') for x in MEDIA_EXTENSIONS)})$")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def unescaped(text: Column) -> Column:
    """Decode named, decimal and hexadecimal character references that end with a semicolon, each once.

    Unknown names stay. Numbers that are no character give the replacement character, and those of the Windows
    control block give that block's characters.
    """
    # A constant for the optimizer: it is parsed once per query. Maps are searched from front to back, so the names are
    # spread over many small ones.
    known = F.from_json(F.lit(json.dumps(_buckets())), "array<map<string,string>>")

    def character(code: Column) -> Column:
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def decoded(piece: Column) -> Column:
        reference = F.regexp_extract(piece, REFERENCE, 1)
        digits = F.regexp_extract(reference, "^#[xX]?(.*)$", 1)
        code = F.when(reference.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        name = F.when(F.startswith(reference, F.lit("#")), F.concat(F.lit("#"), code.cast("string"))).otherwise(reference)
        own = F.get(known, F.pmod(F.crc32(name.cast("binary")), F.lit(NAME_BUCKETS)).cast("int"))
        stated = F.coalesce(F.try_element_at(own, name), F.when(code.isNotNull() & F.startswith(reference, F.lit("#")), character(code)))
        return F.when((reference == "") | stated.isNull(), F.concat(F.lit("&"), piece)).otherwise(
            F.concat(stated, F.substr(piece, F.length(reference) + 2))
        )

    pieces = F.split(text, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


@cache
def _buckets() -> list[dict[str, str]]:
    """The names by crc32 modulo ``NAME_BUCKETS``."""
    buckets: list[dict[str, str]] = [{} for _ in range(NAME_BUCKETS)]
    for name, value in _references().items():
        buckets[crc32(name.encode()) % NAME_BUCKETS][name] = value
    return buckets


@cache
def _references() -> dict[str, str]:
    """Values by name, and by ``#number`` for the Windows control block."""
    named = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
    control = {f"#{code}": bytes([code]).decode("cp1252", "ignore") for code in range(128, 160)}
    return named | {number: value for number, value in control.items() if value}


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` parts of an absolute path."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(part))),
    )
    closing = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), closing)


def joined_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page ``base``."""
    return let(link, lambda x: _joined(base, x))


def _joined(base: Column, link: Column) -> Column:
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = url_path(base)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    link_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    tail = F.substr(link, F.length(link_path) + 1)
    rooted = F.when(F.startswith(link, F.lit("/")), link_path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), link_path)
    )
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(link == "", base)
        .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .when(F.startswith(link, F.lit("?")), F.concat(origin, path, link))
        .otherwise(F.concat(origin, _without_dot_segments(rooted), tail))
    )


ATTRIBUTE = r"""[^\s=>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)"""


def attributes(tag: Column) -> Column:
    """``name=value`` parts of one tag."""
    return F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))


def attribute(parts: Column, name: str) -> Column:
    """Decoded value of a named attribute out of :func:`attributes`; the last one wins; null when absent."""
    named = F.filter(parts, lambda p: p.rlike(rf"^(?i:{name})\s*="))
    value = F.regexp_replace(F.try_element_at(named, F.lit(-1)), r"^[^=]*=\s*", "")
    return unescaped(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"))
